"""Benchmark decontamination by template windows, with DataFrame operations only.

A text is cut into words: runs of anything but white space and ASCII punctuation, and numbers
with the points and commas inside them. In the template a word with a digit in front is a
number, one with a capital in front a name (several in a row are one name, known by its last
word), one of UNITS a unit; all else stays, lower-cased. Windows of five template tokens that
hold a slot, and LITERALS plain words at least, and windows of five lower-cased words are
hashed and joined with those of the items. The second kind sees to passages whose case differs.

Before the join the documents' windows pass a sieve: a bitmap of the items' windows, of
SIEVE_BITS at most whatever the tables' sizes, in which a window must have two bits. It is a
value of the plan, drops nothing that the join would find, and leaves few other windows to be
shuffled. A window travels with the values of its own five words, never with its text.

Joined windows are checked word by word and meet again per row, item and region: shifts
(place in the document less place in the item) that differ by TOLERANCE of the item's words at
most, so that words put in or left out do not part a passage; two grids of cells, one moved by half
a cell, make sure that a region lies whole in one. In a region each value of the item stands
for the value that most of its places show; windows that say otherwise do not count. An item is
found where SHARE of its windows lie under those that count, or, if it has LONG words, SHARE
of its words do: one changed word in a long item hides five windows, but one word.

Defined cases: null and empty texts, and items of fewer than five words, match nothing; items
with equal texts are each found; where one item is found in several regions the best counts
(then the least place); rows are judged each for itself, also those of equal doc_id, and give one
row per doc_id and item for all; a null doc_id is an id like others, but ``clean`` drops only
the rows that hold an item; empty tables on either side give no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import Scratch, packed

#: Words of a window; share of an item that must be found; plain words a template needs; words from which an item is long.
WINDOW, SHARE, LITERALS, LONG = 5, 0.8, 2, 12
#: Shifts of a region differ by this share of the item's words, or by so many words.
TOLERANCE, LEAST_TOLERANCE = 0.2, 4
#: Bits of the sieve for a window of the items, and of the whole of it at least and at most.
BITS_EACH, SIEVE_BITS = 64, (1 << 16, 1 << 24)
UNITS = (
    "mm cm dm m km inch inches ft foot feet yard yards mile miles mg g kg ton tons tonne tonnes oz lb lbs pound pounds ml cl dl l litre litres "
    "liter liters gallon gallons s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year "
    "years hz khz mhz ghz w kw mw wh kwh j kj v kv a ma pa kpa bar kelvin celsius fahrenheit degree degrees percent usd eur gbp dollar dollars "
    "euro euros cent cents kb mb gb tb bit bits byte bytes"
).split()
_WORD = r"[0-9]+(?:[.,][0-9]+)+[^\s\p{Punct}]*|[^\s\p{Punct}]+"
#: Template tokens of the slots; no hash is so small but by a chance of one in 2**60.
_NUM, _NAME, _UNIT = 1, 2, 3
_SLOTS = f"({_NUM}, {_NAME}, {_UNIT})"


def templates(rows: DataFrame) -> DataFrame:
    """rows (..., text) with arrays instead of the text: lit, the words' hashes; of the tokens shape, val
    (the hash of what it stands for), starts and ends (its words, the end without)."""
    own = [c for c in rows.columns if c != "text"]
    cut = rows.select(*own, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(_WORD), F.lit(0)).alias("w"))
    cut = cut.select(*own, "w", F.transform("w", F.lower).alias("low"))
    units = ", ".join(f"'{u}'" for u in UNITS)
    # what begins with a digit lies between '0' and ':'
    slot = f"case when x >= '0' and x < ':' then {_NUM} when x <> l and left(x, 1) <> left(l, 1) then {_NAME} when l in ({units}) then {_UNIT} end"
    cut = cut.select(*own, F.expr("transform(low, l -> xxhash64(l))").alias("lit"), F.expr(f"zip_with(w, low, (x, l) -> coalesce(cast({slot} as bigint), xxhash64(l)))").alias("each"))
    first = f"filter(if(size(each) > 0, sequence(0, size(each) - 1), array()), p -> each[p] <> {_NAME} or p = 0 or get(each, p - 1) <> {_NAME})"
    cut = cut.withColumn("starts", F.expr(first)).withColumn("ends", F.expr("slice(concat(starts, array(size(each))), 2, size(starts))"))
    return cut.select(*own, "lit", "starts", "ends", F.expr("transform(starts, p -> each[p])").alias("shape"), F.expr("transform(ends, e -> lit[e - 1])").alias("val"))


def windows(rows: DataFrame) -> DataFrame:
    """rows of ``templates`` (without their arrays) once for each window: h, t (whether it is one of the
    template), i (its first token, or word), at (its first word), end (the word after it) and vals.

    Windows are rows here, and their hashes are made of single values, so that Spark compiles all of it.
    """
    own = [c for c in rows.columns if c not in ("lit", "starts", "ends", "shape", "val")]
    n = F.greatest(F.size("lit") - (WINDOW - 1), F.lit(0))
    every = rows.withColumn("n_lit", n).withColumn("n_all", F.col("n_lit") + F.greatest(F.size("shape") - (WINDOW - 1), F.lit(0)))
    # outer, and no filter before it: a filter would be pushed down with the arrays' formulas in it
    each = every.select(*own, "lit", "starts", "ends", "shape", "val", "n_lit", F.explode_outer(F.expr("if(n_all > 0, sequence(0, n_all - 1), null)")).alias("k")).where("k is not null")

    def hashed(kind: str, column: str, at: str) -> str:
        return f"xxhash64({kind}, {', '.join(f'{column}[{at} + {j}]' for j in range(WINDOW))})"

    h = F.expr(f"if(k < n_lit, {hashed('false', 'lit', 'k')}, {hashed('true', 'shape', 'k - n_lit')})")
    place = F.expr("if(k < n_lit, k, k - n_lit)")
    return each.select(*own, "lit", "starts", "ends", "shape", "val", h.alias("h"), F.expr("k >= n_lit").alias("t"), place.alias("i"))


#: Of a window: its first word, the word after it, its tokens (or words) and their values.
_AT, _END = "if(t, starts[i], i)", f"if(t, ends[i + {WINDOW - 1}], i + {WINDOW})"
_TOKENS, _VALUES = f"if(t, slice(shape, i + 1, {WINDOW}), slice(lit, i + 1, {WINDOW}))", f"if(t, slice(val, i + 1, {WINDOW}), slice(lit, i + 1, {WINDOW}))"


def known_windows(items: DataFrame) -> DataFrame:
    """h, item_id, n (the item's words), pos, span, i, tokens (of the template, or the words), said (their values) of each window to look up."""
    out = windows(templates(items.select("item_id", "text"))).select(
        "item_id", F.size("lit").alias("n"), "h", "i", "t", F.expr(_AT).alias("pos"), F.expr(f"{_END} - {_AT}").alias("span"), F.expr(_TOKENS).alias("tokens"), F.expr(_VALUES).alias("said")
    )
    plain = F.size(F.expr(f"filter(tokens, x -> x not in {_SLOTS})"))
    return out.where(~F.col("t") | (plain.between(LITERALS, WINDOW - 1))).drop("t")


def sieve_bits(n: int) -> int:
    """Bits for n windows: a power of two within SIEVE_BITS."""
    return min(max(1 << (BITS_EACH * n).bit_length(), SIEVE_BITS[0]), SIEVE_BITS[1])


def sieve(known: DataFrame, bits: int) -> DataFrame:
    """One row: ``bits`` as an array of longs, in which every hash has two set."""
    slots = F.explode(F.array(*[F.expr(p) for p in places("h", bits)]))
    words = known.select(slots.alias("b")).groupBy(F.shiftright("b", 6).alias("k")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("x"))
    every = known.sparkSession.range(bits // 64).select(F.col("id").alias("k")).join(words, "k", "left")
    ordered = F.array_sort(F.collect_list(F.struct("k", F.coalesce("x", F.lit(0)).alias("x"))))  # bits / 64 of them at most
    return every.agg(F.transform(ordered, lambda w: w["x"]).alias("bits"))


def places(h: str, bits: int) -> tuple[str, str]:
    return f"({h} & {bits - 1})", f"(shiftright({h}, 32) & {bits - 1})"


def row_hash(text: str = "text"):
    return F.xxhash64(F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary")))


def found(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, tie (the hash of its text), item_id, n_words, covered, changed_slots, at: the best region of each row and item that reach SHARE."""
    scratch = Scratch(docs.sparkSession, "leaks")
    known = scratch.save(known_windows(items), "items")
    bits = sieve_bits(known.count())
    sieved = scratch.save(sieve(known, bits), "sieve")
    texts = windows(templates(docs.select("doc_id", row_hash().alias("tie"), "text")))
    # the sieve is one value for the plan, not a side of a join
    for place in places("h", bits):
        texts = texts.where(F.get(sieved.scalar(), F.expr(f"cast(shiftright({place}, 6) as int)")).bitwiseAND(F.expr(f"shiftleft(1L, cast({place} & 63 as int))")) != 0)
    hits = texts.select("doc_id", "tie", "h", F.expr(_AT).alias("at"), F.expr(_VALUES).alias("vals"))
    met = hits.join(known.hint("merge"), "h")
    # plain words must be the same, slots may differ
    met = met.where(f"forall(sequence(0, {WINDOW - 1}), j -> tokens[j] in {_SLOTS} or vals[j] = said[j])")
    slots = f"transform(filter(sequence(0, {WINDOW - 1}), j -> tokens[j] in {_SLOTS}), j -> struct(tokens[j] as kind, said[j] as said, vals[j] as stands, i + j as p))"
    met = met.select("doc_id", "tie", "item_id", "n", (F.col("at") - F.col("pos")).alias("shift"), "pos", "span", F.expr(slots).alias("slots"))
    half = F.greatest(F.ceil(F.col("n") * TOLERANCE), F.lit(LEAST_TOLERANCE))
    cells = F.array(*[F.struct(F.lit(g).alias("grid"), F.floor((F.col("shift") + g * half) / (2 * half)).alias("cell")) for g in (0, 1)])
    met = met.withColumn("c", F.explode(cells)).groupBy("doc_id", "tie", "item_id", "n", "c").agg(F.collect_set(F.struct("pos", "span", "shift", "slots")).alias("m"))
    # a region needs so many windows at least to hold SHARE of the words
    met = met.where(f"size(m) * {WINDOW} >= {SHARE} * n or exists(m, x -> x.span > {WINDOW})")
    met = met.withColumn("votes", F.expr("array_distinct(flatten(transform(m, x -> x.slots)))"))
    most = "array_max(transform(filter(votes, v -> v.kind = k.kind and v.said = k.said), v -> struct(size(filter(votes, o -> o.kind = v.kind and o.said = v.said and o.stands = v.stands)) as n, v.stands as stands))).stands"
    met = met.withColumn("told", F.expr(f"transform(array_distinct(transform(votes, v -> struct(v.kind as kind, v.said as said))), k -> struct(k.kind as kind, k.said as said, {most} as stands))"))
    met = met.withColumn("m", F.expr("filter(m, x -> forall(x.slots, s -> exists(told, t -> t.kind = s.kind and t.said = s.said and t.stands = s.stands)))"))
    met = met.withColumn("covered", F.expr("size(array_distinct(flatten(transform(m, x -> sequence(x.pos, x.pos + x.span - 1)))))"))
    met = met.withColumn("matched", F.expr(f"size(array_distinct(flatten(transform(m, x -> sequence(x.pos, x.pos + x.span - {WINDOW})))))"))
    met = met.where(f"matched >= {SHARE} * (n - {WINDOW - 1}) or n >= {LONG} and covered >= {SHARE} * n")
    changed = "size(array_distinct(transform(filter(flatten(transform(m, x -> x.slots)), s -> s.said <> s.stands), s -> struct(s.kind, s.said))))"
    rows = met.select("doc_id", "tie", "item_id", F.col("n").cast("long").alias("n_words"), F.col("covered").cast("long").alias("covered"), F.expr(changed).cast("long").alias("changed_slots"), F.expr("array_min(transform(m, x -> x.shift))").cast("long").alias("at"))
    return best(rows, "doc_id", "tie", "item_id")


def best(rows: DataFrame, *by: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in by]
    order = F.struct("covered", -F.col("changed_slots"), -F.col("at"))
    return rows.groupBy(*by).agg(F.max_by(F.struct(*rest), order).alias("b")).select(*by, "b.*")


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_words, covered, share, changed_slots, at of each item that a document holds.

    docs has doc_id, text; items has item_id, text. at is the word of the document at which the
    item begins (negative if its beginning is missing).
    """
    return best(found(docs, items).drop("tie"), "doc_id", "item_id").select("doc_id", "item_id", "n_words", "covered", (F.col("covered") / F.col("n_words")).alias("share"), "changed_slots", "at")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without the rows that hold an item; all columns stay."""
    held = found(docs.select("doc_id", "text"), items).select(F.col("doc_id").alias("_leaked"), F.col("tie").alias("_tie")).distinct()
    held = Scratch(docs.sparkSession, "leaked").save(held, "docs")
    rows = packed(docs, "doc_id", row_hash().alias("_row"))
    # what is found grows with the corpus: joined by sorting at every size
    return rows.join(held.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_leaked")) & (F.col("_row") == F.col("_tie")), "left_anti").select("_doc.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
