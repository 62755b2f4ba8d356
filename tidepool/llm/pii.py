"""Personal data by rules and a character BiLSTM-CRF.

Rules give the base spans (email, ip, card, phone). A character-level
bidirectional LSTM with CRF transitions over BIO tags, trained here in numpy
on windows labelled with base spans, adds spans that the rules miss. Texts are
cut into overlapping windows; the scores of a character in all its windows are
averaged, weighted towards the windows' middles, and each stretch of
overlapping windows is decoded at once (Viterbi), so no window border cuts a
span and windows cannot contradict each other.

Every span of the four kinds holds an ASCII digit or an ``@``, so windows
without either cannot hold one and are not decoded; that drops no case. A
model span stays only if it overlaps no base span and has its kind's least
evidence (``evidence``).

The model is trained on the driver on at most ``SAMPLE_WINDOWS`` windows, those
with the smallest hash among about ``SAMPLE_DOCS`` documents chosen by hash;
everything else runs in tasks over whole texts.

Defined results: null and empty texts have no spans; without labelled spans
there is no model and the base spans are all; repeated rows and null doc_ids
are handled like any other; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import table

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
SAMPLE_DOCS, SAMPLE_WINDOWS = 3000, 1500
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind
CHARS, PADDING, EMBED, HIDDEN = 131, 130, 16, 24
TRIGGER = re.compile(r"[0-9@]")
# Written so that a long run of characters is passed over once; see ``base_spans``.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def evidence(kind: str, span: str) -> bool:
    """What a model span must hold, whatever stands between its parts."""
    digits = re.sub("[^0-9]", "", span)
    if kind == "email":
        return "@" in span.strip("@") and "." in span
    if kind == "ip":
        parts = re.findall("[0-9]+", span)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the rules, leftmost and not overlapping per kind."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        done = m.end() if m else at + 1  # a run before a failing @ cannot begin a later match
        if m:
            out.append((0, start, m.end()))
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.groups()):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return sorted(out)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def codes(text: str) -> np.ndarray:
    """Character classes: ASCII as it is, 128 other letters, 129 the rest."""
    a = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out = np.minimum(a, 128).astype(np.uint8)
    for i in np.flatnonzero(a >= 128):
        out[i] = 128 if chr(a[i]).isalpha() else 129
    return out


def window_starts(text: str) -> np.ndarray:
    """Starts of the grid's windows that hold a digit or an ``@``."""
    at = np.array([m.start() for m in TRIGGER.finditer(text)], np.int64) // STRIDE * STRIDE
    return np.unique(np.concatenate([at, np.maximum(at - STRIDE, 0)]))


def cut(code: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate([code, np.full(WINDOW, PADDING, np.uint8)])
    return padded[starts[:, None] + np.arange(WINDOW)]


def tags_of(n: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.zeros(n, np.uint8)
    for k, s, e in reversed(spans):  # kinds listed first win where they overlap
        out[s:e] = 2 + 2 * k
        out[s] = 1 + 2 * k
    return out


# transitions that BIO forbids
_MASK = np.zeros((TAGS, TAGS), np.float32)
for _k in range(len(KINDS)):
    _MASK[:, 2 + 2 * _k] = -1e4
    _MASK[1 + 2 * _k, 2 + 2 * _k] = _MASK[2 + 2 * _k, 2 + 2 * _k] = 0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis)) + m.squeeze(axis)


class Tagger:
    """Embedding, one LSTM each way, linear scores, CRF transitions."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        w = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"emb": w(CHARS, EMBED) * 4, "out": w(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32),
                  "trans": np.zeros((TAGS, TAGS), np.float32)}
        for d in "fb":
            b = np.zeros(4 * HIDDEN, np.float32)
            b[HIDDEN:2 * HIDDEN] = 1  # forget gates start open
            self.p |= {f"x{d}": w(EMBED, 4 * HIDDEN), f"h{d}": w(HIDDEN, 4 * HIDDEN), f"b{d}": b}

    def lstm(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """x: steps x batch x EMBED, in the order of reading."""
        pre, wh = x @ self.p[f"x{d}"] + self.p[f"b{d}"], self.p[f"h{d}"]
        h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
        out = np.empty((*x.shape[:2], HIDDEN), np.float32)
        for t in range(len(x)):
            z = pre[t] + h @ wh
            s = sigmoid(z[:, :3 * HIDDEN])
            i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            was_h, was_c, c = h, c, f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep is not None:
                keep.append((i, f, o, g, tc, was_h, was_c))
        return out

    def lstm_back(self, x: np.ndarray, d: str, keep: list, dh_out: np.ndarray, grad: dict) -> np.ndarray:
        wh = self.p[f"h{d}"]
        dz_all = np.empty((*x.shape[:2], 4 * HIDDEN), np.float32)
        dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, tc, was_h, was_c = keep[t]
            dh = dh + dh_out[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * was_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            dz_all[t] = dz
            grad[f"h{d}"] += was_h.T @ dz
            dh, dc = dz @ wh.T, dc * f
        grad[f"x{d}"] += np.einsum("tbe,tbz->ez", x, dz_all)
        grad[f"b{d}"] += dz_all.sum((0, 1))
        return dz_all @ self.p[f"x{d}"].T

    def scores(self, windows: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """windows x steps of classes -> steps x windows x tags."""
        x = self.p["emb"][windows.T]
        kf, kb = ([], []) if keep is not None else (None, None)
        h = np.concatenate([self.lstm(x, "f", kf), self.lstm(x[::-1], "b", kb)[::-1]], 2)
        if keep is not None:
            keep |= {"x": x, "h": h, "f": kf, "b": kb}
        return h @ self.p["out"] + self.p["bias"]

    def step(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the CRF and its gradient."""
        keep: dict = {}
        e = self.scores(windows, keep)
        n, (steps, batch) = windows.shape[0], e.shape[:2]
        y, tr, cols = tags.T, self.p["trans"] + _MASK, np.arange(batch)
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0]  # a window may begin inside a span
        for t in range(1, steps):
            alpha[t] = logsumexp(alpha[t - 1][:, :, None] + tr, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = logsumexp(tr[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = logsumexp(alpha[-1], 1)
        de = np.exp(alpha + beta - z[None, :, None])
        gold = e[0, cols, y[0]]
        dtr = np.zeros_like(tr)
        for t in range(1, steps):
            dtr += np.exp(alpha[t - 1][:, :, None] + tr + (e[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
            np.add.at(dtr, (y[t - 1], y[t]), -1)
            gold = gold + e[t, cols, y[t]] + tr[y[t - 1], y[t]]
        de[np.arange(steps)[:, None], cols[None], y] -= 1
        de /= n
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["trans"] = dtr / n
        g["out"] = np.einsum("tbh,tbk->hk", keep["h"], de)
        g["bias"] = de.sum((0, 1))
        dh = de @ self.p["out"].T
        dx = self.lstm_back(keep["x"], "f", keep["f"], dh[:, :, :HIDDEN], g)
        dx = dx + self.lstm_back(keep["x"][::-1], "b", keep["b"], dh[::-1, :, HIDDEN:], g)[::-1]
        np.add.at(g["emb"], windows.T, dx)
        return float((z - gold).mean()), g

    def train(self, windows: np.ndarray, tags: np.ndarray, steps: int = 150, batch: int = 48, rate: float = 0.015) -> float:
        r, m, v, loss = np.random.default_rng(1), {}, {}, 0.0
        for t in range(1, steps + 1):
            pick = r.choice(len(windows), min(batch, len(windows)), replace=False)
            loss, g = self.step(windows[pick], tags[pick])
            scale = min(1.0, 5 / (np.sqrt(sum(float((x * x).sum()) for x in g.values())) + 1e-9))
            for k, x in g.items():
                x = x * scale
                m[k] = 0.9 * m.get(k, 0) + 0.1 * x
                v[k] = 0.99 * v.get(k, 0) + 0.01 * x * x
                now = rate * (1 - 0.9 * t / steps)
                self.p[k] = (self.p[k] - now * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
        return loss

    def decode(self, e: np.ndarray) -> np.ndarray:
        """Viterbi over steps x batch x tags."""
        tr, steps = self.p["trans"] + _MASK, len(e)
        best, back = e[0], np.empty(e.shape, np.int8)
        for t in range(1, steps):
            way = best[:, :, None] + tr
            back[t] = way.argmax(1)
            best = way.max(1) + e[t]
        out = np.empty(e.shape[:2], np.int8)
        out[-1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            out[t - 1] = np.take_along_axis(back[t], out[t][:, None].astype(int), 1)[:, 0]
        return out


_WEIGHT = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)


def model_spans(model: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Spans of each text: score all windows, average, decode stretch by stretch."""
    code, starts = [codes(t) for t in texts], [window_starts(t) for t in texts]
    every = [(i, s) for i, x in enumerate(starts) for s in x.tolist()]
    stretches: list[tuple[int, int, np.ndarray]] = []
    for lo in range(0, len(every), 512):
        part = every[lo:lo + 512]
        e = model.scores(np.stack([cut(code[i], np.array([s]))[0] for i, s in part])).transpose(1, 0, 2)
        for (i, s), x in zip(part, e):
            last = stretches[-1] if stretches else None
            if last and last[0] == i and s < last[1] + len(last[2]):
                have = last[2]
                grown = np.zeros((s + WINDOW - last[1], TAGS + 1), np.float32)
                grown[:len(have)] = have
                stretches[-1] = last = (i, last[1], grown)
            else:
                last = (i, s, np.zeros((WINDOW, TAGS + 1), np.float32))
                stretches.append(last)
            at = s - last[1]
            last[2][at:at + WINDOW, :TAGS] += x * _WEIGHT[:, None]
            last[2][at:at + WINDOW, TAGS] += _WEIGHT
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted(range(len(stretches)), key=lambda j: len(stretches[j][2]))
    for lo in range(0, len(order), 64):
        part = [stretches[j] for j in order[lo:lo + 64]]
        e = np.zeros((len(part[-1][2]), len(part), TAGS), np.float32)
        for b, (_, _, x) in enumerate(part):
            e[:len(x), b] = x[:, :TAGS] / x[:, TAGS:]
            e[len(x):, b, 1:] = -1e4  # outside
        tags = model.decode(e)
        for b, (i, s, x) in enumerate(part):
            row = tags[:len(x), b]
            for st in np.flatnonzero(row % 2 == 1).tolist():
                end = st + 1
                while end < len(row) and row[end] == row[st] + 1:
                    end += 1
                out[i].append(((int(row[st]) - 1) // 2, s + st, min(s + end, len(texts[i]))))
    return out


def all_spans(model: Tagger | None, texts: list[str]) -> list[tuple[list, list]]:
    """(base spans, base and model spans) of each text."""
    found = model_spans(model, texts) if model else [[] for _ in texts]
    out = []
    for text, more in zip(texts, found):
        base, extra = base_spans(text), []
        for k, s, e in sorted(more, key=lambda x: x[1]):
            if evidence(KINDS[k], text[s:e]) and all(e <= s2 or e2 <= s for _, s2, e2 in base):
                extra.append((k, s, e))
        out.append((base, sorted(base + extra)))
    return out


def fit(spark: SparkSession, docs: DataFrame) -> Tagger | None:
    """Train on labelled windows of a bounded sample (see the module's text)."""
    worth = docs.where(F.col("text").rlike("[0-9@]")).select("text")
    n = worth.count()
    share = int(min(1.0, SAMPLE_DOCS / max(n, 1)) * 1_000_000)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in b.column(0).to_pylist():
                starts = window_starts(text)
                w = cut(codes(text), starts)
                t = np.concatenate([tags_of(len(text), base_spans(text)), np.zeros(WINDOW, np.uint8)])[starts[:, None] + np.arange(WINDOW)]
                rows += [(x.tobytes(), y.tobytes()) for x, y in zip(w, t)]
            if rows:
                yield pa.record_batch([pa.array(x, pa.binary()) for x in zip(*rows)], names=["w", "t"])

    sample = worth.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share).distinct()
    got = sample.mapInArrow(label, "w binary, t binary").orderBy(F.xxhash64("w"), "w").limit(SAMPLE_WINDOWS).collect()
    windows = np.array([np.frombuffer(r.w, np.uint8) for r in got], np.uint8).reshape(len(got), WINDOW)
    tags = np.array([np.frombuffer(r.t, np.uint8) for r in got], np.int64).reshape(len(got), WINDOW)
    if not tags.any():
        return None
    model = Tagger()
    model.train(windows.astype(np.int64), tags)
    return model


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def find_personal_data(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base counts, base_sha256, spans, n_added."""
    model = fit(spark, docs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            have = [i for i, t in enumerate(texts) if t]
            spans: dict[int, tuple[list, list]] = {}
            for lo in range(0, len(have), 200):
                part = have[lo:lo + 200]
                spans |= zip(part, all_spans(model, [texts[i] for i in part]))
            out = [spans.get(i, ([], [])) for i in range(len(texts))]
            cols = [b.column(0)]
            cols += [pa.array([sum(k == kind for k, _, _ in base) for base, _ in out], pa.int64()) for kind in range(len(KINDS))]
            cols += [pa.array([hashlib.sha256(spelled(base).encode()).hexdigest() for base, _ in out]),
                     pa.array([spelled(every) for _, every in out]),
                     pa.array([len(every) - len(base) for base, every in out], pa.int64())]
            yield pa.record_batch(cols, names=[x.split()[0] for x in FOUND.split(", ")])

    # texts without a digit or @ hold nothing and are not sent to Python
    text = F.when(F.col("text").rlike("[0-9@]"), F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).mapInArrow(find, FOUND)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(spark, table(spark, sf_dir, "documents"))
