"""Personal data and terms that disclose it, by information content (operator 8).

Built from DataFrame functions alone.

1. Base spans: e-mail addresses, IP addresses, card and phone numbers, found
   per kind leftmost and non-overlapping, then checked (octets, Luhn, digits).
   Positions come from the lengths of the matches and of the text between them
   (``split``), added up inside the row, so texts are not shuffled.
2. Protected entities are the span texts. The words of a document outside its
   spans are the context of every entity in it, wherever they stand. With ``n``
   documents, a word t and an entity e have ``PMI(e; t) = log2(n * n(t, e) /
   (n(t) * n(e)))`` from counts over all documents; e itself carries ``IC(e) =
   -log2(n(e) / n)`` bits. A word with ``PMI >= DISCLOSURE * IC`` tells nearly
   all of them. That it is no accident is asked in bits as well: every different
   text with both adds PMI bits of evidence, and their sum must exceed the bits
   that name one of all (word, entity) pairs of the corpus by ``MARGIN``.
3. Disclosing words are added as spans of kind ``term`` wherever they stand in a
   document that holds their entity. ``sanitised`` replaces base spans and
   disclosing words: words of digits are generalised to ``<NUMBER>``, others
   removed as ``<TERM>``.

Pairs are built late: an entity on too few texts for the evidence, and a word on
too many documents for its share of the bits, can not be in one, and both are
known from counts. Counts are pre-aggregated in the scan. Rows are told apart by
an id that is written once.

Defined cases: null text counts as empty and has no spans; ``spans`` is then
the empty string; repeated rows give repeated results and count as often as
they occur, but evidence counts different texts, so copies of one document
disclose nothing; ties cannot occur (spans of a kind do not overlap); an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlens.llm.common import text_or_empty, written

DISCLOSURE = 0.9
MARGIN = 4
BLOCK = 256

#: Fixed kinds, in the order in which spans at the same start are listed.
KINDS = ("email", "ip", "card", "phone", "term")

# The base patterns. Where a repetition cannot give back characters to any use,
# it is possessive, and a run is entered at its start only (or where the last
# match ended), which leaves the matches as they are and makes the search linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"[\p{L}\p{N}]+"


def running_sum(values: Column) -> Column:
    """Prefix sums of an array of longs; in blocks, so long arrays cost little more than their length."""
    zero = F.lit(0).cast("long")
    chunks = F.when(F.size(values) == 0, F.array().cast("array<array<bigint>>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK)), lambda k: F.slice(values, (k * BLOCK + 1).cast("int"), BLOCK))
    )

    def sums(xs: Column) -> Column:
        start = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("out"))
        step = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x)).alias("out"))
        return F.aggregate(xs, start, step)["out"]

    inner = F.transform(chunks, sums)
    last = sums(F.transform(inner, lambda xs: F.element_at(xs, -1)))
    bases = F.concat(F.array(zero), last)
    return F.flatten(F.zip_with(inner, F.slice(bases, 1, F.greatest(F.size(bases) - 1, F.lit(0))), lambda xs, base: F.transform(xs, lambda x: x + base)))


def found(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of all matches of ``pattern``; code points, end exclusive."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x).cast("long"))
    steps = F.zip_with(F.slice(between, 1, F.size(values)), values, lambda gap, v: gap + F.char_length(v))
    ends = running_sum(steps)
    return F.zip_with(ends, values, lambda end, v: F.struct((end - F.char_length(v)).alias("start"), end.alias("end"), v.alias("value")))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    digits = F.reverse(F.split(_digits(value), ""))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 1, d.cast("int") * 2).otherwise(d.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda acc, d: acc + F.when(d > 9, d - 9).otherwise(d))
    return total % 10 == 0


def octets_fit(value: Column) -> Column:
    """Whether all parts of a dotted number are at most 255 (long runs of digits are not, unless zeros lead)."""
    return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


SPANS = "array<struct<start:bigint,order:int,end:bigint,kind:string,value:string>>"


def span(start: Column, end: Column, order: int, value: Column) -> Column:
    """A span; sorting spans sorts them by start, then by the order of kinds."""
    return F.struct(
        start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(KINDS[order]).alias("kind"), value.alias("value")
    )


def base_spans(text: Column) -> Column:
    """Array of (start, order, end, kind, value), sorted by start, then kind."""
    length = lambda v: F.char_length(_digits(v))
    rules = {
        "email": (EMAIL, "@", lambda v: F.lit(True)),
        "ip": (IP, ".", octets_fit),
        "card": (CARD, None, lambda v: length(v).between(12, 19) & luhn(v)),
        "phone": (PHONE, "+", lambda v: length(v).between(9, 15)),
    }

    def of_kind(order: int, kind: str, pattern: str, needs: str | None, holds) -> Column:
        possible = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9][0-9 -]{10}")
        spans = F.filter(found(text, pattern), lambda s: holds(s["value"]))
        shaped = F.transform(spans, lambda s: span(s["start"], s["end"], order, s["value"]))
        return F.when(possible, shaped).otherwise(F.array().cast(SPANS))

    return F.array_sort(F.concat(*[of_kind(order, kind, *rule) for order, (kind, rule) in enumerate(rules.items())]))


def count_of(spans: Column, kind: str) -> Column:
    """The number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def words_of(text: Column) -> Column:
    """The distinct words of a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower))


def with_base_spans(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, spans, text, entities): the written table of base spans.

    Rows with spans also have their text and the distinct span texts; others have nulls there.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    spanned = rows.withColumn("spans", base_spans(F.col("text")))
    entities = F.array_distinct(F.transform("spans", lambda s: F.lower(s["value"])))
    some = lambda column: F.when(F.size("spans") > 0, column)
    return written(spanned.select("row_id", "doc_id", "spans", some(F.col("text")).alias("text"), some(entities).alias("entities")), "disclosure-spans")


def free_words(spanned: DataFrame) -> DataFrame:
    """(row_id, free): for rows with spans, (start, end, word) of every word, in lower case, that meets no base span.

    One pass over words and spans of a row, sorted by start: a span that begins
    before a word and ends after the word's start meets it, so the furthest end so
    far decides; so does a span that begins inside the word.
    """
    words = F.transform(found(F.col("text"), WORD), lambda w: span(w["start"], w["end"], KINDS.index("term"), w["value"]))
    # texts are dealt out by row before their words are taken apart, which spares the windows a shuffle of the words
    tasks = int(spanned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = spanned.where(F.size("entities") > 0).repartition(tasks, "row_id")
    both = rows.select("row_id", F.explode(F.concat(words, "spans")).alias("s"))
    both = both.withColumn("word", F.col("s.kind") == "term")
    order = Window.partitionBy("row_id").orderBy("s.start", "word", "s.end")
    back = Window.partitionBy("row_id").orderBy(F.desc("s.start"), F.desc("word"), F.desc("s.end"))
    until = F.max(F.when(~F.col("word"), F.col("s.end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    following = F.min(F.when(~F.col("word"), F.col("s.start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
    meets = F.coalesce(until > F.col("s.start"), F.lit(False)) | F.coalesce(following < F.col("s.end"), F.lit(False))
    free = both.withColumn("meets", meets).where(F.col("word") & ~F.col("meets"))
    return free.groupBy("row_id").agg(F.collect_list(F.struct("s.start", "s.end", F.lower("s.value").alias("word"))).alias("free"))


def disclosing_words(docs: DataFrame, spanned: DataFrame, words: DataFrame, disclosure: float = DISCLOSURE, margin: float = MARGIN) -> DataFrame:
    """(entity, word, pmi, ic): the words that disclose an entity, from counts over the whole corpus; ``words``: ``free_words``."""
    bits = lambda x: F.log2(x.cast("double"))
    n = F.lit(float(max(spanned.count(), 1)))
    held = spanned.where(F.size("entities") > 0).select("row_id", F.xxhash64("text").alias("text_id"), "text", "entities")
    own = words.select("row_id", F.array_distinct("free.word").alias("own"))
    pairs = own.join(held.select("row_id", "entities"), "row_id").agg(F.sum(F.size("own").cast("long") * F.size("entities"))).first()[0]
    needed = margin + math.log2(max(pairs or 0, 1))

    # entities that enough different texts hold: all of these texts together could give the evidence
    by_text = held.select("text_id", F.explode("entities").alias("entity")).groupBy("entity", "text_id").agg(F.count(F.lit(1)).alias("n"))
    entities = by_text.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count(F.lit(1)).alias("n_texts")).withColumn("ic", bits(n) - bits(F.col("n_entity")))
    entities = written(entities.where(F.col("n_texts") * F.col("ic") >= needed), "disclosure-entities")
    # a word's share of the bits allows it so many documents beside those of the entity
    most = F.col("n_entity") * F.pow(F.lit(2.0), (1 - disclosure) * F.col("ic"))
    rows = held.select("row_id", "text_id", F.explode("entities").alias("entity")).join(entities.select("entity", most.alias("most")), "entity")
    rows = written(rows, "disclosure-rows")
    in_play = rows.groupBy("row_id", "text_id").agg(F.max("most").alias("most"))
    row_words = own.join(in_play.select("row_id", "most"), "row_id").select("row_id", "most", F.explode("own").alias("word"))
    words = written(row_words, "disclosure-row-words")
    asked = written(words.select("word").distinct(), "disclosure-asked")
    # counted before the join: a task sends a row per different word, not per occurrence
    everywhere = docs.select(F.explode(words_of(text_or_empty())).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n_all")).join(asked, "word", "left_semi")
    # documents where a word stands in base spans alone do not count
    none = F.array().cast("array<string>")
    inside = held.select("row_id", "text").join(own, "row_id", "left").select(F.explode(F.array_except(words_of(F.col("text")), F.coalesce("own", none))).alias("word"))
    per_inside = inside.join(asked, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n_inside"))
    n_word = F.col("n_all") - F.coalesce("n_inside", F.lit(0))
    counts = everywhere.join(per_inside, "word", "left").select("word", n_word.alias("n_word"))
    rare = written(words.join(counts, "word").where(F.col("n_word") <= F.col("most") * (1 + 1e-9)).select("row_id", "word", "n_word"), "disclosure-rare")

    pairs = rows.join(rare, "row_id").where(F.col("n_word") <= F.col("most") * (1 + 1e-9))
    together = pairs.groupBy("entity", "word", "n_word", "text_id").agg(F.count(F.lit(1)).alias("n")).groupBy("entity", "word", "n_word").agg(
        F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("n_texts")
    )
    scored = together.join(entities.select("entity", "n_entity", "ic"), "entity").withColumn(
        "pmi", bits(n) + bits(F.col("n_both")) - bits(F.col("n_word")) - bits(F.col("n_entity"))
    )
    told = (F.col("pmi") >= disclosure * F.col("ic") - 1e-9) & (F.col("n_texts") * F.col("pmi") >= needed - 1e-9)
    return scored.where(told).select("entity", "word", "pmi", "ic")


def added_spans(docs: DataFrame, spanned: DataFrame, **params) -> DataFrame:
    """(row_id, found): the places of disclosing words, outside base spans, in documents that hold their entity."""
    words = written(free_words(spanned), "disclosure-words")
    told = written(disclosing_words(docs, spanned, words, **params).select("entity", "word"), "disclosure-told")
    marked = spanned.where(F.size("entities") > 0).select("row_id", F.explode("entities").alias("entity")).join(told, "entity").select("row_id", "word").distinct()
    places = words.join(marked.select("row_id").distinct(), "row_id", "left_semi").select("row_id", F.inline("free"))
    hits = places.join(marked, ["row_id", "word"], "left_semi")
    return hits.groupBy("row_id").agg(F.collect_list(span(F.col("start"), F.col("end"), KINDS.index("term"), F.col("word"))).alias("found"))


def sanitise_spans(docs: DataFrame, **params) -> DataFrame:
    """One row per document: row_id, doc_id, base (spans), spans (base and added, sorted)."""
    spanned = with_base_spans(docs)
    added = added_spans(docs, spanned, **params)
    none = F.array().cast(SPANS)
    return (
        spanned.select("row_id", "doc_id", F.col("spans").alias("base"))
        .join(added, "row_id", "left")
        .withColumn("spans", F.array_sort(F.concat("base", F.coalesce("found", none))))
        .drop("found")
    )


def sanitised(text: Column, spans: Column) -> Column:
    """The text with base spans replaced by their kind and disclosing words generalised or removed.

    Overlapping base spans are replaced by the one that starts first.
    """
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def mark(s: Column) -> Column:
        term = F.when(s["value"].rlike("^[0-9]+$"), F.lit("<NUMBER>")).otherwise(F.lit("<TERM>"))
        return F.when(s["kind"] == "term", term).otherwise(F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        inside = s["start"] < acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], kept, mark(s))).alias("out")
        )

    end = F.aggregate(spans, start, step)
    return F.concat(end["out"], F.substring(text, (end["at"] + 1).cast("int"), F.char_length(text)))
