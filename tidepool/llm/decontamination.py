"""Benchmark decontamination by template windows.

Texts and benchmark items become token sequences in which numbers, names
(capitalised words inside a sentence, not words in capitals) and units after a
number are typed placeholders. Every window of ``WINDOW`` tokens of an item is
a template; its hash is looked up in every document. A hit is checked on the
tokens themselves, and the slots of all hits of one alignment of a document with an
item must be consistent: equal values of the item stand for equal values of
the document and different for different ones. So a question asked again with
other numbers or names is caught, and a text that merely has numbers and names
in the same places is not.

What counts as a name depends on capitals and on the characters before it, so
items and documents are read twice: *typed*, as above, and *plain*, with all
words but numbers and units as lower-cased literals. A window counts when it is
found in either reading; slots must be consistent within a reading's alignment.
So copies in other case, without punctuation or with other white space are
found where a search for lower-cased words finds them. Windows without names
are the same in both readings and hashed once.

Everything is DataFrame functions. The documents are read once and not moved:
a table of the templates' hashes (at most ``MAX_SIEVE`` bytes; when crowded it
only lets more candidates pass) sieves each document's windows inside the
array, and only the windows that pass are exploded and joined.

A document is contaminated by an item when at least ``NEED`` of the item's
windows (all, if it has fewer in both readings or in the typed one alone) are
found in consistent alignments. Templates
with fewer than half literal tokens are too general and left out; so are items
of fewer than ``MIN_TOKENS`` tokens.

Defined results: null or empty texts hold nothing; null doc_ids are reported
as null; repeated rows are each reported; empty tables give an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import table, with_place, written

WINDOW = 10
NEED = 4
MIN_TOKENS = 4
MAX_SIEVE = 1 << 22
PART_BITS = 17
PART = 1 << PART_BITS
NAME, UNIT, NUMBER = 1, 2, 3
# Units recognised after a number.
UNITS = ["mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "l", "s", "min", "h", "percent", "inch", "inches", "foot", "feet",
         "yards", "mile", "miles", "pound", "pounds", "ounces", "second", "seconds", "minute", "minutes", "hour", "hours",
         "day", "days", "week", "weeks", "month", "months", "year", "years", "dollars", "cents", "euros", "meters", "metres",
         "kilometers", "kilometres", "grams", "kilograms", "liters", "litres"]


def tokens(text: Column) -> Column:
    """Lower-cased words; names start with U+0001, units with U+0002."""
    t = F.translate(F.coalesce(text, F.lit("")), "\x01\x02", "  ")
    names = r"([\p{L}\p{N},;][\s\p{Z}]+)(?=\p{Lu}\p{Ll})"
    units = r"(?i)([0-9][\s\p{Z}]+)(?=(?:" + "|".join(UNITS) + r")\b)"
    t = F.when(t.rlike(r"[0-9][\s\p{Z}]+\p{L}"), F.regexp_replace(t, units, "$1\x02")).otherwise(t)
    t = F.when(t.rlike(names), F.regexp_replace(t, names, "$1\x01")).otherwise(t)
    return F.array_remove(F.split(F.lower(t), r"[^\p{L}\p{N}\x01\x02]+"), "")


def kind(token: Column) -> Column:
    """Placeholder type of a token, null for a literal."""
    c = F.ascii(token)
    return F.when(c == 1, F.lit(NAME)).when(c == 2, F.lit(UNIT)).when(c.between(48, 57), F.lit(NUMBER))


def has_names(words: Column) -> Column:
    return F.exists(words, lambda x: F.ascii(x) == NAME)


def plain(words: Column) -> Column:
    """The words with names as literals."""
    return F.transform(words, lambda x: F.translate(x, "\x01", ""))


def canonical(token: Column) -> Column:
    return F.coalesce(kind(token).cast("string"), token)


def windows(token: Column, symbol: Column, w: int) -> Column:
    """Array of (at, hash) of all windows of ``w`` symbols."""
    n = F.size(token)
    at = F.when(n >= w, F.sequence(F.lit(0), n - w)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice(symbol, i + 1, w)).alias("hash")))


def symbols(token: Column) -> Column:
    return F.transform(token, lambda t: F.coalesce(kind(t).cast("long"), F.xxhash64(t)))


def templates(spark: SparkSession, items: DataFrame) -> DataFrame:
    """One row per window of an item and reading (typed only where the window
    has names): item_id, w, item_at, hash, item_words, typed, item_named,
    item_windows and, of the typed reading alone, typed_windows."""
    t = items.select("item_id", tokens(F.col("text")).alias("marked")).where(F.size("marked") >= MIN_TOKENS)
    t = t.withColumn("w", F.least(F.size("marked"), F.lit(WINDOW)))
    t = t.select("item_id", "w", "marked", F.explode(F.array(F.lit(False), F.lit(True))).alias("typed"))
    t = t.withColumn("words", F.when(F.col("typed"), F.col("marked")).otherwise(plain(F.col("marked"))))
    t = t.withColumn("s", symbols(F.col("words")))
    each = [t.where(F.col("w") == w).select("item_id", "w", "marked", "words", "typed", F.explode(windows(F.col("words"), F.col("s"), w)).alias("x"))
            for w in range(MIN_TOKENS, WINDOW + 1)]
    out = each[0]
    for e in each[1:]:
        out = out.unionByName(e)
    out = out.select("item_id", "w", "typed", F.col("x.at").alias("item_at"), F.col("x.hash").alias("hash"),
                     F.slice("words", F.col("x.at") + 1, F.col("w")).alias("item_words"),
                     has_names(F.slice("marked", F.col("x.at") + 1, F.col("w"))).alias("item_named"))
    literal = F.size(F.filter("item_words", lambda x: kind(x).isNull()))
    out = written(spark, out.where((literal * 2 >= F.col("w")) & (~F.col("typed") | F.col("item_named"))), "templates")
    in_typed = F.col("typed") | ~F.col("item_named")
    n = out.groupBy("item_id").agg(F.countDistinct("item_at").alias("item_windows"),
                                   F.countDistinct(F.when(in_typed, F.col("item_at"))).alias("typed_windows"))
    return written(spark, out.join(n, "item_id"), "templates")


def sieve(templates_: DataFrame, slots: int) -> Column:
    """The templates' hashes as a literal of ``slots`` bytes, 1 where a hash
    falls, in an array of binaries of ``PART`` bytes: descriptions of plans spell
    a large binary out, an array's elements they don't, and the driver's heap
    takes small pieces more easily. Bitmaps of 32,768 slots reach the driver,
    ``slots / 8`` bytes."""
    at = templates_.select(F.pmod(F.col("hash"), F.lit(slots)).alias("slot"))
    bitmaps = (at.groupBy(F.expr("slot div 32768").alias("part"))
               .agg(F.bitmap_construct_agg(F.col("slot") % 32768).alias("bits")).collect())
    out = bytearray(-(-slots // 32768) * 32768)
    for r in bitmaps:
        for i, byte in enumerate(bytes(r.bits)):
            if byte:
                for j in range(8):
                    out[r.part * 32768 + i * 8 + j] = byte >> j & 1
    return F.array(*[F.lit(bytes(out[at:at + PART])) for at in range(0, slots, PART)])


def sieved(w: int, slots: int, held: Column, typed: bool) -> Column:
    """The windows of ``w`` words that pass the sieve, with their words: all in
    the plain reading, those with names in the typed one."""
    words, s = ("typed_words", "typed_s") if typed else ("words", "s")

    def passes(x: Column) -> Column:
        at = F.pmod(x["hash"], F.lit(slots)).cast("int")
        part = F.element_at(held, F.shiftright(at, PART_BITS) + 1)
        return F.substring(part, at.bitwiseAND(F.lit(PART - 1)) + 1, F.lit(1)) == F.lit(b"\x01")

    def with_words(x: Column) -> Column:
        named = has_names(F.slice("typed_words", x["at"] + 1, w))
        return F.struct(x["at"].alias("at"), x["hash"].alias("hash"), F.lit(w).alias("w"), F.slice(words, x["at"] + 1, w).alias("words"),
                        F.lit(typed).alias("typed"), named.alias("named"))

    found = F.transform(F.filter(windows(F.col(words), F.col(s), w), passes), with_words)
    return F.filter(found, lambda x: x["named"]) if typed else found


def contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of documents and items: place_file, place_row, doc_id, item_id,
    matched_windows, item_windows, n_slots."""
    index = templates(spark, items)
    lengths = sorted((r.w, r.n) for r in index.groupBy("w").agg(F.count("*").alias("n")).collect())
    d = with_place(docs.select("doc_id", "text")).select("place_file", "place_row", "doc_id", tokens(F.col("text")).alias("marked"))
    none = F.array().cast("array<string>")  # without names, both readings are the same
    d = d.select("place_file", "place_row", "doc_id", "marked", has_names(F.col("marked")).alias("any"))
    d = d.select("place_file", "place_row", "doc_id", F.when(F.col("any"), F.col("marked")).otherwise(none).alias("typed_words"),
                 F.when(F.col("any"), plain(F.col("marked"))).otherwise(F.col("marked")).alias("words"))
    d = d.select("*", symbols(F.col("words")).alias("s"), symbols(F.col("typed_words")).alias("typed_s"))
    found = F.array().cast("array<struct<at:int,hash:bigint,w:int,words:array<string>,typed:boolean,named:boolean>>")
    for w, n in lengths:
        slots = min(MAX_SIEVE, max(1 << 12, 1 << (64 * n - 1).bit_length()))
        held = sieve(index.where(F.col("w") == w), slots)
        found = F.concat(found, sieved(w, slots, held, False), sieved(w, slots, held, True))
    hits = d.select("place_file", "place_row", "doc_id", F.explode(found).alias("x")).select("place_file", "place_row", "doc_id", "x.*")
    same = F.forall(F.zip_with("words", "item_words", lambda a, b: canonical(a) == canonical(b)), lambda ok: ok)
    both = F.zip_with("words", "item_words", lambda a, b: F.struct(kind(a).alias("kind"), a.alias("here"), b.alias("there")))
    slots = F.filter(both, lambda x: x["kind"].isNotNull())
    # a pair of windows without names belongs to both readings
    readings = (F.when(F.col("typed"), F.array(F.lit(True))).when(F.col("named") | F.col("item_named"), F.array(F.lit(False)))
                .otherwise(F.array(F.lit(False), F.lit(True))))
    pairs = hits.join(index, ["w", "hash", "typed"]).where(same).withColumn("slots", slots).withColumn("reading", F.explode(readings))
    keys = ["place_file", "place_row", "doc_id", "item_id", "item_windows", "typed_windows"]
    aligned = (pairs.groupBy(*keys, "reading", (F.col("at") - F.col("item_at")).alias("shift"))
               .agg(F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"), F.collect_set("item_at").alias("ats")))
    # as many (here, there) pairs as values on either side: a one-to-one map
    distinct = lambda side: F.size(F.array_distinct(F.transform("slots", lambda x: F.struct(x["kind"], x[side]))))
    held = aligned.where((F.size("slots") == distinct("here")) & (F.size("slots") == distinct("there")))
    matched = lambda ats: F.size(F.array_distinct(F.flatten(F.collect_list(ats))))
    out = held.groupBy(*keys).agg(matched("ats").alias("matched_windows"), matched(F.when(F.col("reading"), F.col("ats"))).alias("typed_matched"),
                                  F.max(F.size("slots")).alias("n_slots"))
    enough = (F.col("matched_windows") >= F.least(F.lit(NEED), F.col("item_windows"))) | (
        (F.col("typed_windows") > 0) & (F.col("typed_matched") >= F.least(F.lit(NEED), F.col("typed_windows"))))
    return out.where(enough).drop("typed_windows", "typed_matched")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and item."""
    out = contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", F.col("matched_windows").cast("long").alias("matched_windows"),
                      F.col("item_windows").cast("long").alias("item_windows"), F.col("n_slots").cast("long").alias("n_slots"))
