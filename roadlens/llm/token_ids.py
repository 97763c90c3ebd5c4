"""Token ids by the ``tokenizers`` library, encoding each distinct piece once.

BPE works inside pretokens, and no pretoken of the two supported kinds of
tokenizer crosses the cuts made here (at white space, and between letters and
ASCII marks), so the ids of a text are the ids of its pieces in order. A batch
is cut in vectorised passes over its bytes, and Arrow's dictionary encoding
finds the distinct pieces, compared byte for byte; only these reach Python and
the library, thousands of new ones a call. Where the tokenizer drops white
space and case, so do the pieces, which leaves fewer of them. Each worker keeps
the pieces it has met in two batches or more in a cache of bounded size; most
pieces come once and would only take room there.
Texts with unusual white space, and tokenizers of any other kind, are encoded
whole. ``tests/llm`` holds both ways against each other.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash

CACHE_PIECES = 600_000
#: Places of the marks that tell whether a piece came before (equal places only keep a piece earlier).
MET = 1 << 23
LONGEST_HASHED = 64
WHOLE, WORDS, SPACE_LED = "whole", "words", "space-led"


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free code from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Bytes with which white space besides ``SPACES`` begins, in the sense of Python or of Unicode.
SUSPECT = np.isin(np.arange(256), [0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3])
MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 63, LONGEST_HASHED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


LETTERS = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
MARKS = np.isin(np.arange(256), [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
APOSTROPHE = 39
#: First bytes of two-byte letters, U+00C0 to U+017F but the two signs among them.
LATIN_LEAD = np.isin(np.arange(256), [0xC3, 0xC4, 0xC5])
#: Tables for ``bytes.translate``: what a byte is, as one bit, and whether unusual white space may begin there.
A_LETTER, A_MARK, A_LEAD, A_SPACE = 1, 2, 4, 8
BYTE_KINDS = (A_LETTER * LETTERS + A_MARK * MARKS + A_LEAD * LATIN_LEAD + A_SPACE * SPACES).astype(np.uint8).tobytes()
SUSPECT_BYTES = SUSPECT.tobytes()
#: ASCII capitals as small letters, all other bytes as they are.
SMALL = bytes(range(256)).lower()
SPACE_BYTES = bytes(np.flatnonzero(SPACES).tolist())
#: What a piece holds, to be joined by "or": ASCII letters, marks, bytes of Latin letters up to U+023F, or what no simple piece has.
LATIN, OTHER = 4, 8
HOLDS = np.full(256, OTHER, np.uint8)
HOLDS[LETTERS], HOLDS[MARKS], HOLDS[32], HOLDS[APOSTROPHE] = A_LETTER, A_MARK, 0, OTHER
HOLDS[0x80:0xC0] = HOLDS[0xC3:0xC9] = LATIN
HOLDS = HOLDS.tobytes()
#: Pieces are handed to the library so many at a time, with this letter (the stand-in of a line feed) between them.
MANY = 4096
BETWEEN = BYTE_LETTERS[10]


def unusual_space(data: np.ndarray) -> np.ndarray:
    """Positions in UTF-8 bytes where white space besides the six ASCII characters begins."""
    at = np.flatnonzero(np.frombuffer(data.tobytes().translate(SUSPECT_BYTES), bool))
    padded = np.concatenate([data, np.zeros(2, np.uint8)])
    a, b, c = padded[at], padded[at + 1], padded[at + 2]
    hit = a < 0x20
    hit |= (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    hit |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    hit |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
    hit |= (a == 0xE2) & (b == 0x81) & (c == 0x9F)
    hit |= (a == 0xE3) & (b == 0x80) & (c == 0x80)
    return at[hit]


def piece_bounds(data: np.ndarray, off: np.ndarray, space_led: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of all texts in a batch.

    ``space_led``: as byte-level pretokenizers cut at white space. A run of it
    is a piece, but its last character, before a word, stands apart; if it is a
    space it leads that word. Otherwise pieces are the words between white space.
    """
    n = len(data)
    space = SPACES[data]
    first = np.zeros(n + 1, bool)
    first[off] = True  # where a text begins; at n the end
    first_in, before = first[:n], np.concatenate([[False], space[:-1]])
    if not space_led:
        starts = np.flatnonzero(~space & (before | first_in))
        after = np.concatenate([space[1:], [True]]) | first[1:]
        return starts, np.flatnonzero(~space & after) + 1
    after_word = np.concatenate([~space[1:], [False]]) & ~first[1:]
    lead = np.concatenate([[False], data[:-1] == 32])
    start = space & (~before | first_in) | space & after_word | ~space & (first_in | before & ~lead)
    starts = np.flatnonzero(start)
    return starts, np.concatenate([starts[1:], [n]])


def pretoken_cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of pieces that cover all texts: the space-led ones, cut again between letters and ASCII marks.

    After an apostrophe there is no cut, as it may begin a contraction.
    """
    starts, _ = piece_bounds(data, off, True)
    if len(data) < 2:
        return starts
    cut = marks_apart(data, byte_kinds(data.tobytes()))
    cut[starts[starts > 0] - 1] = False
    return np.sort(np.concatenate([starts, np.flatnonzero(cut) + 1]), kind="stable")


def byte_kinds(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw.translate(BYTE_KINDS), np.uint8)


def marks_apart(data: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Whether a cut between a letter and an ASCII mark comes after each byte but the last."""
    letter, mark = kinds == A_LETTER, kinds == A_MARK
    lead = np.flatnonzero(kinds[:-1] == A_LEAD)
    lead = lead[(data[lead] != 0xC3) | (data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    begins, ends = letter.copy(), letter
    begins[lead] = True
    ends[lead + 1] = True
    cut = begins[1:] & mark[:-1]
    cut &= data[:-1] != APOSTROPHE
    cut |= mark[1:] & ends[:-1]
    return cut


def word_cuts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the pieces between white space, cut as ``pretoken_cuts`` does; their bytes in
    small letters without the space, and their bounds there."""
    raw = data.tobytes()
    kinds = byte_kinds(raw)
    solid = kinds != A_SPACE
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    start[off[:-1][off[:-1] < len(data)]] = True
    start &= solid
    if len(data) > 1:
        start[1:] |= marks_apart(data, kinds)
    end = solid.copy()
    end[:-1] &= ~solid[1:] | start[1:]
    starts = np.flatnonzero(start)
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(np.flatnonzero(end) + 1 - starts, out=bounds[1:])
    return starts, np.frombuffer(raw.translate(SMALL, SPACE_BYTES), np.uint8), bounds


def piece_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece: multilinear in its bytes; long pieces by xxhash."""
    size = ends - starts
    upto = np.concatenate([[0], np.cumsum(size)])
    within = np.arange(upto[-1]) - np.repeat(upto[:-1], size)
    at = within + np.repeat(starts, size)
    terms = (data[at].astype(np.uint64) + np.uint64(1)) * MULTIPLIERS[within % LONGEST_HASHED]
    names = np.add.reduceat(terms, upto[:-1]) if len(size) else np.zeros(0, np.uint64)
    names ^= names >> np.uint64(29)
    for k in np.flatnonzero(size > LONGEST_HASHED):
        names[k] = xxhash.xxh64_intdigest(data[starts[k] : ends[k]].tobytes())
    return names


def stretches(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``begins[i]`` to ``begins[i] + sizes[i] - 1`` of every i, one after the other."""
    upto = np.cumsum(sizes, dtype=np.int64)
    out = np.repeat(begins - upto + sizes, sizes)
    out += np.arange(len(out))
    return out


def lone_signs(raw: bytes) -> np.ndarray:
    """Positions of the two-byte signs among Latin letters, and of the capital that small letters spell as two."""
    data = np.frombuffer(raw, np.uint8)
    lead, then = data[:-1], data[1:]
    return np.flatnonzero((lead == 0xC3) & ((then == 0x97) | (then == 0xB7)) | (lead == 0xC4) & (then == 0xB0))


class Encoder:
    """Ids for batches of texts; one instance a worker process (see ``encoder``)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        spec = json.loads(self.tokenizer.to_str())
        self.kind = self._kind(spec)
        if self.kind != WHOLE:
            self._prepare_many(spec["model"].get("end_of_word_suffix"))
        self.ids_type = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self._clear()

    @staticmethod
    def _kind(spec: dict) -> str:
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            return SPACE_LED
        steps = pre.get("pretokenizers") or [{}]
        drops_space = steps[0].get("type") == "Split" and steps[0].get("invert") and steps[0].get("behavior") == "Removed"
        kinds = [x.get("type") for x in (norm or {}).get("normalizers", [])]
        if drops_space and r"[^\s\p{L}\p{N}]+" in steps[0]["pattern"].get("Regex", "") and kinds == ["NFC", "Replace", "Lowercase"]:
            return WORDS
        return WHOLE

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.met = np.zeros(MET, bool)
        self.flat = np.zeros(1 << 20, self.ids_type)
        self.ends = np.zeros(1 << 16, np.int32)  # of each known piece in ``flat``

    def _prepare_many(self, suffix: str | None) -> None:
        """The tokenizer's own model over pretokens with ``BETWEEN`` between them, and the ids at which one ends.

        A model with a suffix of words tells their last ids by it; else the letter between them has its own id.
        """
        from tokenizers import Tokenizer, pre_tokenizers

        vocabulary = self.tokenizer.get_vocab()
        self.suffixed = bool(suffix)
        self.many = Tokenizer(self.tokenizer.model)
        self.many.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(BETWEEN) if suffix else pre_tokenizers.Split(BETWEEN, "isolated")
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.last[[n for piece, n in vocabulary.items() if (piece.endswith(suffix) if suffix else piece == BETWEEN)]] = True

    def encode_whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _ids_of_simple(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, sizes)`` of single pretokens, by the tokenizer's BPE model."""
        letters = b"\n".join(pieces)
        if letters.isascii():
            letters = letters.decode().replace("\n", BETWEEN).replace(" ", BYTE_LETTERS[32])
        else:
            if self.kind == WORDS:  # in lower case
                letters = letters.decode().lower().encode()
            letters = letters.decode("latin-1").translate(BYTE_LETTERS)
        [found] = self.many.encode_batch_fast([letters if self.suffixed else letters + BETWEEN], add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        last = self.last[ids]
        sizes = np.diff(np.flatnonzero(last), prepend=-1)
        if not self.suffixed:
            ids, sizes = ids[~last], sizes - 1
        if len(sizes) == len(pieces) and sizes.sum() == len(ids):
            return ids, sizes
        lists = [[t.id for t in self.tokenizer.model.tokenize(word)] for word in letters.split(BETWEEN)]
        return np.fromiter(chain.from_iterable(lists), np.int64), np.fromiter(map(len, lists), np.int64, len(lists))

    def _ids_of(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, sizes)`` of pieces: single pretokens by the tokenizer's BPE model, the rest by the whole tokenizer."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        upto = np.cumsum(sizes)
        joined = b"".join(pieces)
        holds = np.bitwise_or.reduceat(np.frombuffer(joined.translate(HOLDS), np.uint8), upto - sizes)
        holds[np.searchsorted(upto, lone_signs(joined), "right")] = OTHER
        plain = (holds == A_LETTER) | (holds == A_MARK)
        simple = plain | (holds == LATIN) | (holds == A_LETTER | LATIN)
        ids, sizes = [np.zeros(0, np.int64)], np.zeros(len(pieces), np.int64)
        order = np.argsort(2 - plain - simple.view(np.int8), kind="stable")
        n = int(simple.sum())
        for lo in range(0, n, MANY):
            at = order[lo : min(lo + MANY, n)]
            part, sizes[at] = self._ids_of_simple([pieces[k] for k in at.tolist()])
            ids.append(part)
        for lo in range(n, len(pieces), MANY):
            at = order[lo : lo + MANY]
            lists = self.encode_whole([pieces[k].decode() for k in at.tolist()])
            sizes[at] = [len(x) for x in lists]
            ids.append(np.fromiter(chain.from_iterable(lists), np.int64))
        begins = (np.cumsum(sizes) - sizes)[order]
        out = np.zeros(int(sizes.sum()), np.int64)
        out[stretches(begins, sizes[order])] = np.concatenate(ids)
        return out, sizes

    def _learn(self, new: list[bytes], kept: int) -> None:
        """Puts the ids of ``new`` behind the known pieces; only the first ``kept`` stay there after this batch."""
        ids, sizes = self._ids_of(new)
        base, used = len(self.known), self.ends[len(self.known) - 1] if self.known else 0
        ends = used + np.cumsum(sizes)
        while int(ends[-1]) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while base + len(new) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[used : ends[-1]] = ids
        self.ends[base : base + len(new)] = ends
        self.known.update(zip(new[:kept], range(base, base + kept)))

    def __call__(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of the texts ``data[off[i]:off[i+1]]`` (UTF-8 bytes)."""
        odd = np.ones(len(off) - 1, bool)
        if self.kind != WHOLE:
            odd = np.diff(np.searchsorted(unusual_space(data), off)) > 0
        if odd.any():
            return self._mixed(data, off, odd)
        if self.kind == WORDS:
            starts, data, bounds = word_cuts(data, off)
        else:
            starts = pretoken_cuts(data, off)
            bounds = np.append(starts, len(data)).astype(np.int64, copy=False)
        if not len(starts):
            return np.zeros(0, self.ids_type), np.zeros(len(off), np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        _, ends, raw = pieces.dictionary.buffers()
        ends, raw = np.frombuffer(ends, np.int64)[: len(pieces.dictionary) + 1].tolist(), raw.to_pybytes()
        distinct = [raw[a:b] for a, b in zip(ends, ends[1:])]
        if len(self.known) > CACHE_PIECES:
            self._clear()
        rows = list(map(self.known.get, distinct))
        new = [k for k, row in enumerate(rows) if row is None]
        if new:
            base = len(self.known)
            place = np.fromiter(map(hash, [distinct[k] for k in new]), np.int64, len(new)) % MET
            again = self.met[place]
            self.met[place] = True
            new = [new[k] for k in np.argsort(~again, kind="stable").tolist()]
            self._learn([distinct[k] for k in new], int(again.sum()))
            for n, k in enumerate(new):
                rows[k] = base + n
        row = np.array(rows, np.int32)
        ends = self.ends[row]
        begins = np.where(row > 0, self.ends[row - 1], 0)
        which = pieces.indices.to_numpy()
        sizes = (ends - begins)[which]
        upto = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        ids = self.flat[stretches(begins[which], sizes)]
        return ids, upto[np.searchsorted(starts, off)]

    def _mixed(self, data: np.ndarray, off: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts: list = [None] * len(odd)
        good = np.flatnonzero(~odd)
        if len(good):
            size = np.diff(off)[good]
            at = np.concatenate([[0], np.cumsum(size)])
            ids, upto = self(np.concatenate([data[off[i] : off[i + 1]] for i in good]), at)
            for k, i in enumerate(good):
                parts[i] = ids[upto[k] : upto[k + 1]]
        for i in np.flatnonzero(odd):
            parts[i] = np.asarray(self.encode_whole([data[off[i] : off[i + 1]].tobytes().decode()])[0], self.ids_type)
        upto = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return np.concatenate([np.zeros(0, self.ids_type), *parts]), upto


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for the tokenizer file at ``path``."""
    return Encoder(path)
