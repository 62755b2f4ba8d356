"""Removal of near-duplicate lines by a deletion-neighbourhood join.

A line is its sequence of words. Two lines are near when at most ``1`` word is
inserted, deleted or replaced (lines under ``MIN_WORDS`` words: none). Every
line emits, as hashed keys, itself and all its variants with one word deleted,
with the position of the deletion. Lines with an equal variant from the same
position differ in that word; a line that equals a variant of another lacks
that word. The earliest partner of a line is then a minimum per key; pairs are
not formed. The edit distance of a line and its earliest partner is verified
on the words.

A line goes when it is not the first occurrence of its words, or when an
earlier line is near it; order is by doc_id (null last), then place in the
table, then line number.

Variants are emitted only for lines that can have a partner: with one edit,
the first or the last half of the words is the same. Halves are taken for the
line's own length and for one word less, so lengths that differ by one meet.

Defined results: null and empty texts have no lines (0 removed); lines without
words stay and have no partner; repeated rows are later occurrences; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import likely, table, with_place, written
from tidepool.llm.shingles import U, mix, pieces, powers, word_hashes

MIN_WORDS = 5
_BASE = U(0xD6E8FEB86659FD93)
_BACK = U(pow(int(_BASE), -1, 2 ** 64))
LINES = "file long, row long, doc_id long, line int, words int, key long, half1 long, half2 long, half3 long, half4 long"


class Sequences:
    """Hashes of word runs of the lines of one piece."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        breaks = np.flatnonzero(data == 10) + 1
        self.starts = np.union1d(off[:-1][np.diff(off) > 0], breaks[breaks < len(data)])
        inner = np.setdiff1d(breaks, self.starts)  # a break at the end of a text opens one more, empty line
        self.extra = np.searchsorted(off, inner[np.isin(inner, off)], side="left") - 1
        lines = np.concatenate([self.starts, [len(data)]])
        words, self.first = word_hashes(data, lines)
        self.row = np.searchsorted(off, self.starts, side="right") - 1
        self.line = np.arange(len(self.row)) - np.searchsorted(self.row, self.row)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(len(words), _BASE))])
        self.back = powers(len(words) + 2, _BACK)

    def run(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the words a to b, as a polynomial from exponent 0."""
        return (self.total[b] - self.total[a]) * self.back[a]


def sealed(h: np.ndarray, n: np.ndarray, tag: int = 0) -> np.ndarray:
    return mix(h ^ mix(n.astype(np.uint64) * U(8) + U(tag))).view(np.int64)


def line_maker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        place = [b.column(i).to_numpy(zero_copy_only=False) for i in range(2)]
        for at, data, off in pieces(b.column("text")):
            if not len(data):
                continue
            s = Sequences(data, off)
            a, z = s.first[:-1], s.first[1:]
            n = z - a
            cols = [s.line, n, sealed(s.run(a, z), n)]
            for c in (n, n - 1):
                h = np.maximum(c, 0) // 2
                cols += [sealed(s.run(a, a + h), c + 1, 1), sealed(s.run(z - (np.maximum(c, 0) - h), z), c + 1, 2)]
            i = s.row + at
            kinds = [np.int32, np.int32] + [np.int64] * 5
            yield pa.record_batch([pa.array(place[0][i]), pa.array(place[1][i]), b.column("doc_id").take(pa.array(i)),
                                   *[pa.array(c.astype(k)) for c, k in zip(cols, kinds)]], names=[x.split()[0] for x in LINES.split(", ")])


def variant_maker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Listed lines -> (variant, position of the deletion or -1, rank)."""
    for b in batches:
        lists = b.column("lines").to_pylist()
        for at, data, off in pieces(b.column("text")):
            if not len(data):
                continue
            s = Sequences(data, off)
            base = np.searchsorted(s.row, np.arange(len(off) - 1))
            want = [(base[r] + x["line"], x["rank"]) for r in range(len(off) - 1) for x in lists[at + r]]
            which, rank = (np.array(x, np.int64) for x in zip(*want)) if want else (np.zeros(0, np.int64),) * 2
            for lo in range(0, len(which), 2000):
                w, k = which[lo:lo + 2000], rank[lo:lo + 2000]
                a, z = s.first[w], s.first[w + 1]
                n = z - a
                each = np.repeat(np.arange(len(w)), n)
                p = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                i = a[each] + p
                h = s.run(a[each], i) + (s.total[z[each]] - s.total[i + 1]) * s.back[a[each] + 1]
                yield pa.record_batch([pa.array(np.concatenate([sealed(h, n[each] - 1), sealed(s.run(a, z), n)])),
                                       pa.array(np.concatenate([p, np.full(len(w), -1)]).astype(np.int32)),
                                       pa.array(np.concatenate([k[each], k]))], names=["variant", "at", "rank"])


def text_maker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for text, lines in zip(b.column("text").to_pylist(), b.column("lines").to_pylist()):
            parts = text.split("\n")
            yield pa.record_batch([pa.array([x["rank"] for x in lines], pa.int64()),
                                   pa.array([parts[x["line"]] for x in lines], pa.string())], names=["rank", "line_text"])


_SPACES = str.maketrans("\t\x0b\x0c\r", "    ")
_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def line_words(line: str) -> list[str]:
    return [w for w in line.translate(_SPACES).translate(_SMALL).split(" ") if w]


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether at most one word is inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def verifier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ok = [within_one(line_words(x), line_words(y)) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        yield pa.record_batch([b.column(0).filter(pa.array(ok))], names=["rank"])


def repeated_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: file, row (its place), doc_id, n_lines,
    n_removed, removed (line numbers from 0)."""
    placed = with_place(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select(
        F.xxhash64("place_file").alias("file"), F.col("place_row").alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lines = written(spark, placed.mapInArrow(line_maker, LINES), "lines")
    order = [F.col("doc_id").isNull().alias("late"), F.col("doc_id"), F.col("file"), F.col("row"), F.col("line")]
    first = (lines.where("words > 0").groupBy("key", "words", "half1", "half2", "half3", "half4")
             .agg(F.min(F.struct(*order)).alias("at")))
    first = written(spark, first, "first-lines")

    # lines that share half of their words with another line, ranked in corpus order
    long = first.where(F.col("words") >= MIN_WORDS)
    meet = Window.partitionBy("half")
    gate = (long.select("key", F.explode(F.array("half1", "half2", "half3", "half4")).alias("half"))
            .withColumn("n", F.count("*").over(meet)).where("n > 1").select("key").distinct())
    ranked = (long.join(gate, "key").select("key", "at").orderBy("at.late", "at.doc_id", "at.file", "at.row", "at.line")
              .withColumn("rank", F.monotonically_increasing_id()))
    ranked = written(spark, ranked.select("key", "rank", "at.file", "at.row", "at.line"), "ranked-lines")

    def of_lines(some: DataFrame) -> DataFrame:
        lists = some.groupBy("file", "row").agg(F.collect_list(F.struct("line", "rank")).alias("lines"))
        lists = written(spark, lists, "line-lists")
        return (placed.select("file", "row", "text").where(likely(spark, lists, ["file", "row"]))
                .join(lists, ["file", "row"]).select("text", "lines"))

    variants = of_lines(ranked).mapInArrow(variant_maker, "variant long, at int, rank long")
    same, hole = Window.partitionBy("variant"), Window.partitionBy("variant", "at")
    partner = (variants.withColumn("n", F.count("*").over(same))
               .withColumn("whole", F.min(F.when(F.col("at") < 0, F.col("rank"))).over(same))
               .withColumn("longer", F.min(F.when(F.col("at") >= 0, F.col("rank"))).over(same))
               .withColumn("replaced", F.min("rank").over(hole)).where("n > 1")
               .select("rank", F.when(F.col("at") < 0, F.col("longer")).otherwise(F.least("whole", "replaced")).alias("partner"))
               .where("partner < rank").groupBy("rank").agg(F.min("partner").alias("partner")))
    partner = written(spark, partner, "line-partners")

    needed = ranked.join(partner.select(F.explode(F.array("rank", "partner")).alias("rank")).distinct(), "rank", "left_semi")
    texts = written(spark, of_lines(needed).mapInArrow(text_maker, "rank long, line_text string"), "line-texts")
    near = (partner.join(texts, "rank").withColumnRenamed("line_text", "a")
            .join(texts.select(F.col("rank").alias("partner"), F.col("line_text").alias("b")), "partner")
            .select("rank", "a", "b").mapInArrow(verifier, "rank long"))

    fate = first.select("key", "words", "at").join(ranked.join(near, "rank", "left_semi").select("key", F.lit(True).alias("near")), "key", "left")
    fate = written(spark, fate, "line-fates")
    judged = lines.where("words > 0").join(fate.select("key", "at", "near"), "key").select(
        "file", "row", "line", (F.col("near").isNotNull() | (F.col("at") != F.struct(*order))).alias("gone"))
    counts = judged.where("gone").groupBy("file", "row").agg(F.sort_array(F.collect_list("line")).alias("removed"))
    n_lines = lines.groupBy("file", "row").agg(F.max("line").alias("last"))
    return (placed.select("file", "row", "doc_id").join(n_lines, ["file", "row"], "left").join(counts, ["file", "row"], "left")
            .select("file", "row", "doc_id", F.coalesce(F.col("last") + 1, F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("removed", F.array().cast("array<int>")).alias("removed")))


def without_lines(text, removed):
    """Column: ``text`` without the lines numbered in ``removed``."""
    lines = F.split(text, "\n", -1)
    kept = F.filter(F.arrays_zip(lines.alias("l"), F.sequence(F.lit(0), F.size(lines) - 1).alias("i")),
                    lambda x: ~F.array_contains(removed, x["i"]))
    return F.array_join(F.transform(kept, lambda x: x["l"]), "\n")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeated_lines(spark, table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.concat_ws(",", F.transform("removed", lambda x: x.cast("string"))).alias("removed"))


OP3_SQL = r"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE text IS NOT NULL AND text <> ''
), w AS (
  SELECT doc_id, i, list_filter(regexp_split_to_array(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[ \t\x0B\f\r]+'), lambda x: x <> '') AS ws
  FROM raw
), f AS (
  SELECT ws, min((doc_id, i)) AS at, row_number() OVER (ORDER BY min((doc_id, i))) AS rank FROM w WHERE len(ws) > 0 GROUP BY ws
), v AS (
  SELECT rank, -1 AS hole, md5(array_to_string(ws, chr(1))) AS v FROM f WHERE len(ws) >= 5
  UNION ALL
  SELECT rank, k, md5(array_to_string(list_concat(ws[1:k], ws[k + 2:]), chr(1)))
  FROM (SELECT rank, ws, unnest(range(0, len(ws))) AS k FROM f WHERE len(ws) >= 5)
), near AS (
  SELECT DISTINCT rank FROM (
    SELECT rank, hole, min(rank) OVER (PARTITION BY v, hole) AS replaced,
           min(CASE WHEN hole < 0 THEN rank END) OVER (PARTITION BY v) AS whole,
           min(CASE WHEN hole >= 0 THEN rank END) OVER (PARTITION BY v) AS longer
    FROM v)
  WHERE CASE WHEN hole < 0 THEN longer < rank ELSE least(replaced, whole) < rank END
), gone AS (
  SELECT w.doc_id, count(*) AS n, string_agg(CAST(w.i AS VARCHAR), ',' ORDER BY w.i) AS removed
  FROM w JOIN f ON w.ws = f.ws LEFT JOIN near ON near.rank = f.rank
  WHERE near.rank IS NOT NULL OR f.at <> (w.doc_id, w.i) GROUP BY w.doc_id
)
SELECT d.doc_id, CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
       coalesce(gone.n, 0) AS n_removed, coalesce(gone.removed, '') AS removed
FROM documents d LEFT JOIN gone ON gone.doc_id = d.doc_id
"""
