"""The labelled URL table of the URL filter: words by family, and the rule that makes URLs of them.

The words were chosen as common names of trades and subjects, without regard to
any table of pages. A family is one trade; words of unwanted trades are labelled
block, all others allow. Invented names, made of syllables, are labelled allow:
what says nothing is not blocked.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

# Words of unwanted trades, by family.
BLOCK = {
    "gambling": "casino poker roulette blackjack slots jackpot betting bets bingo lottery wager gamble baccarat bookmaker",
    "medicine": "pills viagra cialis pharma meds steroids painkiller prescription weightloss diet xanax tramadol",
    "adult": "adult porn sex xxx nude erotic escort cams fetish milf hookup strip",
    "piracy": "warez torrent torrents crack keygen serials pirate nulled iptv rapidshare cracked modapk",
    "spam": "spam linkfarm doorway backlinks seo traffic clickbait scraper farm autoblog leads bulk",
    "adverts": "ads adserver adtrack banner popup popunder tracker tracking pixel affiliate doubleclick clicks",
    "loans": "loans payday lender cashadvance debt forex credit binary profit getrich moneyfast payout",
    "copies": "replica rolex handbags knockoff counterfeit fakes imitation discount outlet cheap wholesale clearance",
    "fraud": "phishing verify-account login-secure giveaway prize winner win free claim reward lucky bonus",
    "harm": "malware spyware exploit botnet trojan keylogger hacked carding fullz ddos ransom stealer",
}
# Words of other subjects, by family.
ALLOW = {
    "press": "news times post journal gazette herald tribune chronicle magazine reporter weekly daily",
    "learning": "school university college academy library course lecture campus student teacher science research",
    "places": "city town village river mountain valley harbour island bridge garden castle station",
    "food": "recipes kitchen bakery cooking cheese bread coffee restaurant vegetable orchard wine market",
    "health": "hospital clinic nursing dental therapy wellness doctor medicine fitness yoga vision heart",
    "sports": "football tennis running cycling swimming hockey rugby cricket athletics league stadium racing",
    "arts": "music theatre museum gallery cinema poetry painting orchestra dance festival photo literature",
    "state": "council government parliament ministry justice police embassy election customs archive statute census",
    "travel": "hotel railway airport holidays cruise travel camping hostel ferry tourism journey explore",
    "technology": "software hardware computer network database robot sensor compiler kernel developer cloud data",
    "homes": "house furniture plumbing carpet window painting lighting roofing joinery tools bricks timber",
    "nature": "forest ocean wildlife birds weather climate geology astronomy botany insects water energy",
    "trade": "shop store books clothing shoes insurance bank logistics factory engineering consulting accounting",
    "people": "family children community church charity history heritage genealogy society club forum blog",
    "tongues": "nachrichten schule stadt gesundheit actualites ecole ville sante noticias escuela ciudad salud",
}
#: Words that stand beside both kinds.
BESIDE = ("best", "online", "my", "the", "top", "new", "world", "city", "24", "pro")
PREFIXES = ("", "www.", "blog.", "m.", "shop.")
SUFFIXES = ("com", "org", "net", "info", "de", "fr", "co.uk", "test")
PATHS = ("/", "/en/12", "/fr/3045/", "/de/77.html", "/es/981", "/index.php", "/a/b/c", "")
INVENTED = 1200
CONSONANTS, VOWELS, ENDS = "b c d f g h k l m n p r s t th v w ch st br".split(), "a e i o u ea ou".split(), ["", "n", "r", "s", "t", "l", "nd", "st"]


def names_of(words: list[str]) -> Iterator[tuple[str, list[str]]]:
    """(host name, the words in it): every word alone, beside a common word, and with the next words of its family."""
    for i, word in enumerate(words):
        yield word, [word]
        for k in range(3):
            beside = BESIDE[(i + 3 * k) % len(BESIDE)]
            yield (f"{beside}-{word}", f"{word}{beside}", f"{beside}{word}s")[k], [word]
        for k in (1, 2):
            other = words[(i + k) % len(words)]
            yield (f"{word}-{other}" if k == 1 else f"{word}{other}"), [word, other]


def invented(n: int) -> str:
    """The n-th invented name: two to four syllables drawn by hash."""
    draw = lambda k, options: options[zlib.crc32(f"{n}:{k}".encode()) % len(options)]
    return "".join(draw(3 * k, CONSONANTS) + draw(3 * k + 1, VOWELS) + draw(3 * k + 2, ENDS) for k in range(2 + zlib.crc32(str(n).encode()) % 3))


def labelled_urls() -> Iterator[tuple[str, int, list[str]]]:
    """(url, 1 = block, the words its host was made of) of the whole table."""
    made = [(name, blocked, words) for blocked, families in ((1, BLOCK), (0, ALLOW)) for text in families.values() for name, words in names_of(text.split())]
    made += [(invented(n), 0, []) for n in range(INVENTED)]
    for i, (name, blocked, words) in enumerate(made):
        pick = zlib.crc32(name.encode())
        for k in range(2):
            prefix, suffix, path = PREFIXES[(pick + 2 * k) % len(PREFIXES)], SUFFIXES[(pick // 7 + 3 * k) % len(SUFFIXES)], PATHS[(pick // 61 + 5 * k) % len(PATHS)]
            yield f"https://{prefix}{name}.{suffix}{path}", blocked, words
