"""URL filter, language ID, personal data, decontamination."""

import random
import re

import numpy as np
import pytest
from llm_fixture import ROWS, WORDS, sentence
from pyspark.sql import functions as F

from tidepool.llm import decontamination, language_id, pii, url_filter

URLS = ["http://a.spam-farm.example.net/x", "https://EXAMPLE.org/es/1?q", "http://example.org/en/12#t", "http://example.org", "x://deep.example.org/en/2",
        "http://b.com/fr/1", "http://b.com/de/1", "http://b.com/it", "ftp://casino-win.example.com/fr/9", None, "", "no scheme/path",
        "http://", "http://h?x=/fr/", "a://b://c/d", "http://xorg/", "http://notexample.org/es/"]


def judge(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].lower(), m[2]) if m else ("", "")
    fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
    listed = any(x in url_filter.LISTED_NAMES for x in host.split("."))
    return host, path, rule, verdict or ("block" if listed else "allow"), listed


def test_url_verdicts(spark):
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS * 2)], "page_id long, url string, host string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict, r.listed) for r in url_filter.judge_pages(spark, df).collect()}
    assert got == {(i, *judge(u)) for i, u in enumerate(URLS * 2)}
    assert url_filter.judge_pages(spark, df.limit(0)).count() == 0


@pytest.mark.parametrize("share,max_bits", [(20, url_filter.MAX_BITS), (2, url_filter.MAX_BITS), (3, 512)])
def test_cascade_is_exact(spark, share, max_bits):
    """Every key of the universe, in one part and in several."""
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % share == 0).alias("listed"))
    rows = universe.select("key", F.col("listed").alias("want"))
    out = url_filter.with_listed(spark, rows, "key", universe, max_bits)
    assert out.count() == 3000 and out.where("listed != want").count() == 0
    cascade = url_filter.Cascade(spark, universe)
    assert len(cascade.levels) > 1  # false positives are encoded in turn


def test_codewords_correct_errors():
    for k in (3, 4, 5, 12, 40):
        code = language_id.codewords(k)
        assert len({tuple(r) for r in code}) == k and (np.abs(code.sum(0)) < k).all()
        assert k < 4 or language_id.distance(code) >= 3
    code = language_id.codewords(4)
    model = language_id.Model(("a", "b", "c", "d"), code, np.zeros((1, 7)), np.ones(7) / 7, (language_id.distance(code) - 1) // 2)
    for i in range(4):
        margins = code[[i]].copy()
        margins[0, 2] *= -0.5  # one weakly wrong bit
        best, score, doubt = language_id.decode(model, margins)
        assert best[0] == i and not doubt[0] and 0 <= score[0] <= 1


def test_language_accuracy(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    from tidepool.llm.catalog import QUERIES

    got = QUERIES["op7_language_id"](spark, sf_small).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert held.count() > 20 and held.where("lang = lang_pred").count() >= 0.95 * held.count()


def test_language_of_odd_rows(spark, docs, no_docs):
    predict = language_id.predictor(language_id.fit_documents(docs))
    got = {r.doc_id: r.p for r in docs.select("doc_id", predict("text").alias("p")).collect()}
    assert all(got[d].lang_pred == "und" and got[d].score == 0 for d in (60, 61, 62, 63))
    assert all(got[d].lang_pred in ("aa", "bb") and 0 <= got[d].score <= 1 for d in (0, 64, 67))
    assert language_id.fit_documents(no_docs).langs == ()
    alone = language_id.predictor(language_id.fit(docs.where("lang = 'aa'")))
    assert {r[0] for r in docs.where("doc_id = 1").select(alone("text")["lang_pred"]).collect()} == {"aa"}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    out = [(0, *m.span()) for m in EMAIL.finditer(t)]
    out += [(1, *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(t) if 13 <= len(re.sub("[^0-9]", "", m.group())) <= 19 and pii.luhn(re.sub("[^0-9]", "", m.group()))]
    out += [(3, *m.span()) for m in PHONE.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans_match_the_plain_patterns():
    r = random.Random(2)
    for _ in range(30_000):
        t = "".join(r.choice("ab@..1+- (9%_\n") for _ in range(r.randint(0, 30)))
        assert pii.base_spans(t) == plain_spans(t), t
    for t in ("card 4111 1111 1111 1111.", "1.2.3.4 and 256.1.1.1", "9" * 20_000, "a" * 20_000 + "@b.c", "+1 (212) 555-7668, x@y.co"):
        assert pii.base_spans(t) == plain_spans(t)


def private(r):
    return [f"{r.choice(WORDS)}.{r.randint(1, 99)}@{r.choice(WORDS)}.example.com", f"+1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}",
            ".".join(str(r.randint(0, 255)) for _ in range(4))]


def test_tagger_learns_and_reconciles():
    """Trained on labelled spans, the model finds spans of unseen texts across window borders."""
    r = random.Random(4)
    texts = []
    for _ in range(260):
        parts = [sentence(r, r.randint(3, 20)) for _ in range(3)]
        texts.append(f"{parts[0]} {r.choice(private(r))} {parts[1]} {r.choice(private(r))} {parts[2]}")
    train, test = texts[:200], texts[200:]
    w = [(pii.cut(pii.codes(t), s), np.concatenate([pii.tags_of(len(t), pii.base_spans(t)), np.zeros(pii.WINDOW, np.uint8)])[s[:, None] + np.arange(pii.WINDOW)])
         for t in train for s in [pii.window_starts(t)]]
    model = pii.Tagger()
    model.train(np.concatenate([x for x, _ in w]).astype(np.int64), np.concatenate([y for _, y in w]).astype(np.int64), steps=120)
    want = [set(pii.base_spans(t)) for t in test]
    got = [set(x) for x in pii.model_spans(model, test)]
    hit = sum(len(a & b) for a, b in zip(want, got))
    assert hit >= 0.8 * sum(map(len, want)) and hit >= 0.7 * sum(map(len, got))
    for t, (base, every) in zip(test, pii.all_spans(model, test)):
        assert set(base) <= set(every) and base == plain_spans(t)


def test_crf_gradient():
    model, rng = pii.Tagger(3), np.random.default_rng(0)
    x, y = rng.integers(0, 100, (2, 7)), rng.integers(0, 2, (2, 7))
    _, g = model.step(x, y)
    for k, i in (("trans", (0, 1)), ("out", (3, 1)), ("hf", (2, 5)), ("xb", (1, 30)), ("bias", (0,))):
        p, h = model.p[k], 1e-2
        p[i] += h
        up = model.step(x, y)[0]
        p[i] -= 2 * h
        down = model.step(x, y)[0]
        p[i] += h
        assert abs((up - down) / (2 * h) - g[k][i]) < 0.02 * max(1, abs(g[k][i]))


def test_personal_data_of_documents(spark, docs, no_docs):
    r = random.Random(6)
    extra = [(1000 + i, f"{sentence(r, 4)} {' '.join(private(r))}", "x") for i in range(20)]
    table = docs.select("doc_id", "text", "n").unionByName(spark.createDataFrame(extra, "doc_id long, text string, n string"))
    rows = pii.find_personal_data(spark, table).collect()
    assert len(rows) == len(ROWS) + 20
    for row in rows:
        text = {d: t for d, t in ROWS if d is not None}.get(row.doc_id) if (row.doc_id or 0) < 1000 else dict((d, t) for d, t, _ in extra)[row.doc_id]
        if row.doc_id is not None:
            base = plain_spans(text or "")
            assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]
            assert set(filter(None, pii.spelled(base).split(","))) <= set(row.spans.split(","))
    assert pii.find_personal_data(spark, no_docs).count() == 0


def test_decontamination(spark, docs, no_docs, tmp_path):
    r = random.Random(9)
    item = "then Tom has 5 apples and gives 5 of them to " + sentence(r, 6) + " before he walks 12 km home with Ann"
    plain = sentence(r, 30)
    other = item.replace("5", "8").replace("12", "30").replace("Tom", "Bob").replace("Ann", "Eve")
    mixed = item.replace("has 5", "has 9").replace("gives 5", "gives 4")  # one slot, two values
    rows = [(1, f"{sentence(r, 20)} {plain.upper()}. {sentence(r, 9)}", "a"), (2, other, "b"), (3, f"{sentence(r, 5)} {item}", "c"),
            (4, mixed, "d"), (5, sentence(r, 200), "e"), (6, None, "f"), (7, "", "g"), (1, f"{sentence(r, 20)} {plain}", "h"), (8, plain[:40], "i")]
    spark.createDataFrame(rows, "doc_id long, text string, hash string").write.parquet(str(tmp_path / "d"))
    items = spark.createDataFrame([(10, plain), (11, item), (12, None), (13, "too short"), (14, "seven words in this one item here")], "item_id long, text string")
    got = sorted((x.doc_id, x.item_id) for x in decontamination.contaminated(spark, spark.read.parquet(str(tmp_path / "d")), items).collect())
    assert [x for x in got if x[0] != 4] == [(1, 10), (1, 10), (2, 11), (3, 11)]
    # without its inconsistent alignment, nothing of document 4 is left
    assert (4, 11) not in got
    assert decontamination.contaminated(spark, no_docs, items).count() == 0
    assert decontamination.contaminated(spark, docs, items.limit(0)).count() == 0


def test_decontamination_of_copies_in_other_dress(spark, tmp_path):
    """Copies that a search for lower-cased words finds: other case, no
    punctuation, other white space; and names changed after a line break."""
    r = random.Random(12)
    start = sentence(r, 3)
    item = f"{start}. The {sentence(r, 8)}; When Tom has 5 km to go, Ann {sentence(r, 7)}. Later {sentence(r, 6)}"
    short = "The old Tom Miller and his dog Rex walk to the sea"
    copies = [item, item.lower(), item.upper(), item.title(), re.sub(r"[^\w ]", "", item), item.replace(" ", "\n"), item.replace(" ", "  "),
              item.replace("Tom", "Bob").replace("Ann", "Eve").replace(" ", "\n")]
    shorts = [short, short.lower(), short.upper(), short.title(), short.replace(" ", "  ")]
    rows = [(i, f"{sentence(r, 9)} {t} {sentence(r, 9)}") for i, t in enumerate(copies + shorts)] + [(99, sentence(r, 300).title())]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    items = spark.createDataFrame([(1, item), (2, short)], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontamination.contaminated(spark, spark.read.parquet(str(tmp_path / "d")), items).collect()}
    assert got == {(i, 1) for i in range(8)} | {(i, 2) for i in range(8, 13)}


def test_only_letters_make_a_language(spark):
    rows = [(i, "le chat est sur la table " * 3 if i % 2 else "the cat is on the table " * 3, "fr" if i % 2 else "en") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judge = language_id.predictor(language_id.fit_documents(df))
    odd = spark.createDataFrame([("½ ² Ⅷ",), ("½",), ("_",), ("٣",), ("é",), ("漢",), ("the ½",)], "text string")
    got = [r.p.lang_pred for r in odd.select(judge("text").alias("p")).collect()]
    assert got[:4] == ["und"] * 4 and "und" not in got[4:]
    assert spark.createDataFrame([], df.schema).select(judge("text").alias("p")).count() == 0
    nobody = language_id.predictor(language_id.fit_documents(df.limit(0)))
    assert {r.p.lang_pred for r in odd.select(nobody("text").alias("p")).collect()} == {"und"}


def test_solving_by_features_equals_solving_by_texts(monkeypatch):
    import numpy as np

    r = np.random.default_rng(0)
    vectors, langs = r.random((60, 12)).astype(np.float32), [["a", "b", "c"][i % 3] for i in range(60)]
    monkeypatch.setattr(language_id, "N_FEATURES", 12)
    few = language_id.train(vectors, langs)
    monkeypatch.setattr(language_id, "N_FEATURES", 100)
    many = language_id.train(vectors, langs)
    assert np.allclose(few.weights, many.weights, atol=1e-4)
