"""Language identification with error-correcting output codes.

Each language gets a codeword of +1/-1 bits; one binary classifier per bit is
fitted (ridge regression onto the bit, closed form) on hashed byte 2- and
3-gram frequencies of whole texts. A text's bit margins are decoded to the
codeword with the least weighted exponential loss, each bit weighted by its
training accuracy. A text is ambiguous when its bits differ from the chosen
codeword in more places than the code can correct.

The classifiers are fitted on a bounded sample: at most ``per_lang`` labelled
texts of each language and about ``SAMPLE`` of all, chosen by hash of doc_id.
The sample's texts are turned into vectors of fixed length by tasks; only these
vectors reach the driver, where the system solved has at most ``N_FEATURES``
rows. The fitted weights (``N_FEATURES`` x bits) go to the tasks.

Defined results: null texts and texts without a letter are ``und`` (score 0);
so is everything when no labelled text exists. With one learned language all
other texts get it (score 1). Letters are Unicode's (``\\p{L}``): fractions,
superscripts and Roman numeral signs are none. Equal losses go to the language
first in alphabetical order. Null doc_ids are never learned from and count as
not held out. Texts of any length are read whole. Repeated rows are judged
alike; an empty table gives no rows; extra columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import table

N_FEATURES = 4096
PER_LANG = 300
RIDGE = 0.3
SHARPNESS = 3.0
SAMPLE = 20_000  # texts of all languages together; fewer a language where there are very many
LETTER = r"\p{L}"
_LETTER = regex.compile(LETTER)
# bytes that are not letters (ASCII) become a space, so n-grams see word ends
_BYTE = np.arange(256, dtype=np.uint32)
_BYTE[[i for i in range(128) if not chr(i).isalpha()]] = 32


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    code: np.ndarray      # languages x bits, +1/-1
    weights: np.ndarray   # features x bits
    bit_weight: np.ndarray
    radius: int           # wrong bits the code corrects


def ngram_vector(text: str) -> np.ndarray:
    """Unit vector of the square roots of hashed 2- and 3-gram counts of the
    whole text, lower-cased, with a space at both ends."""
    a = _BYTE[np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)]
    two = (a[:-1] * np.uint32(0x9E3779B1) + a[1:] * np.uint32(0x85EBCA77)) >> np.uint32(21)
    three = (a[:-2] * np.uint32(0xC2B2AE3D) + a[1:-1] * np.uint32(0x27D4EB2F) + a[2:] * np.uint32(0x165667B1)) >> np.uint32(21)
    half = N_FEATURES // 2
    v = np.sqrt(np.concatenate([np.bincount(two, minlength=half), np.bincount(three, minlength=half)]).astype(np.float32))
    return v / max(float(np.sqrt((v * v).sum())), 1e-9)


def codewords(k: int) -> np.ndarray:
    """Code matrix for ``k`` languages: all different splits up to 5 languages
    (the exhaustive code), else the best of some seeded random codes of about
    10 log2(k) bits. No bit is constant."""
    if k < 2:
        return np.zeros((k, 0), np.float32)
    if k <= 5:
        cols = [c for c in product((1, -1), repeat=k) if c[0] == 1 and -1 in c]
        return np.array(cols, np.float32).T
    rng, best, most = np.random.default_rng(0), None, -1
    n = int(np.ceil(10 * np.log2(k)))
    for _ in range(200):
        c = rng.choice(np.array([-1, 1], np.float32), size=(k, n))
        c = c[:, np.abs(c.sum(0)) < k]
        d = distance(c)
        if d > most:
            best, most = c, d
    return best


def distance(code: np.ndarray) -> int:
    """Least number of bits in which two codewords differ."""
    k, n = code.shape
    return int(min(((n - code[i] @ code[j]) / 2 for i in range(k) for j in range(i)), default=n))


def train(vectors: np.ndarray, langs: list[str]) -> Model:
    names = tuple(sorted(set(langs)))
    code = codewords(len(names))
    y = code[[names.index(x) for x in langs]] if names else np.zeros((0, 0), np.float32)
    if not code.shape[-1]:
        return Model(names, code, np.zeros((N_FEATURES, 0), np.float32), np.zeros(0), 0)
    x = vectors.astype(np.float64)
    size = np.array([1 / langs.count(names[i]) for i in range(len(names))])
    w = np.array([size[names.index(v)] for v in langs])
    w *= len(langs) / w.sum()  # languages count alike
    xw, yw = x * np.sqrt(w)[:, None], np.sqrt(w)[:, None] * y
    if len(x) <= N_FEATURES:  # two ways to the same weights: by texts or by features, whichever are fewer
        weights = xw.T @ np.linalg.solve(xw @ xw.T + RIDGE * np.eye(len(x)), yw)
    else:
        weights = np.linalg.solve(xw.T @ xw + RIDGE * np.eye(N_FEATURES), xw.T @ yw)
    right = ((x @ weights) * y > 0).mean(0)
    bit = np.clip(right - 0.5, 0.01, None)
    return Model(names, code, weights.astype(np.float32), bit / bit.sum(), (distance(code) - 1) // 2)


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language index, score and ambiguity of each row of bit margins."""
    if len(model.langs) == 1:
        n = len(margins)
        return np.zeros(n, int), np.ones(n), np.zeros(n, bool)
    m = np.clip(margins, -4, 4)
    loss = (np.exp(-SHARPNESS * m[:, None, :] * model.code[None]) * model.bit_weight).sum(2)
    p = np.exp(-(loss - loss.min(1, keepdims=True)))
    best = loss.argmin(1)
    score = p[np.arange(len(p)), best] / p.sum(1)
    wrong = (np.sign(m) != model.code[best]).sum(1)
    return best, score, wrong > model.radius


def fit(labelled: DataFrame, per_lang: int = PER_LANG) -> Model:
    """Fit on ``labelled(doc_id, text, lang)``, a bounded sample of it."""
    n_langs = labelled.where("lang IS NOT NULL").select("lang").distinct().count()
    per_lang = max(1, min(per_lang, SAMPLE // max(n_langs, 1)))
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select("lang", "doc_id")
    # about twice the sample of each language by a hash bound, so that no task sees a whole language
    share = known.groupBy("lang").agg((F.lit(2.0 * per_lang) / F.count("*")).alias("share"))
    few = (known.join(F.broadcast(share), "lang")
           .where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.col("share") * (1 << 30)).select("lang", "doc_id"))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = few.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= per_lang).select("doc_id", "lang").distinct()

    @F.pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([ngram_vector(t).astype(np.float16).tobytes() for t in texts])

    # at most per_lang ids of each language, a few kB each
    rows = labelled.join(F.broadcast(ids), ["doc_id", "lang"]).where(has_letter("text"))
    got = rows.groupBy("doc_id", "lang").agg(F.max("text").alias("text")).select("lang", vector("text").alias("v")).collect()
    got = sorted((r.lang, bytes(r.v)) for r in got)
    x = np.array([np.frombuffer(v, np.float16) for _, v in got], np.float32).reshape(len(got), N_FEATURES)
    return train(x, [k for k, _ in got])


def has_letter(col: str) -> Column:
    return F.col(col).rlike(LETTER)


def predictor(model: Model):
    """A column function: text -> struct(lang_pred, score, ambiguous)."""

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"lang_pred": "und", "score": 0.0, "ambiguous": True}, index=texts.index)
        ok = [i for i, t in enumerate(texts) if t is not None and model.langs and _LETTER.search(t)]
        for at in range(0, len(ok), 256):
            part = ok[at:at + 256]
            best, score, doubt = decode(model, np.stack([ngram_vector(texts.iloc[i]) for i in part]) @ model.weights)
            out.iloc[part, 0] = [model.langs[b] for b in best]
            out.iloc[part, 1] = score
            out.iloc[part, 2] = doubt
        return out

    return predict


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit_documents(docs: DataFrame) -> Model:
    return fit(docs.where(~held_out()).select("doc_id", "text", "lang"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predict = predictor(fit_documents(docs))
    out = docs.select("doc_id", held_out().alias("held_out"), predict("text").alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.ambiguous")
