"""Token counts, whitening and ranked search against the library or brute force, on the
small tables and on awkward rows (NULLs, empty and very long texts, ties, repeated rows,
clashing extra columns, empty tables)."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import SF_MID, SF_SMALL

from offerlake.llm import common, queries, ranked_search, token_counts, whitening

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
CLASH = ("n_bytes string, n_tokens string, item string, term string, doc string, level string, met string, lower string, "
         "n string, v string, d string, component string, `rank` string, score string")
PAD = ("z",) * 14


def _model():
    with open(MODEL, "rb") as f:
        return token_counts.load(f.read())


# --- 11: token counts ----------------------------------------------------------------------

def _texts(n):
    rng = random.Random(11)
    library = _model().library
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    kinds = (lambda: "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 40))),
             lambda: "".join(rng.choice("abet hsi") for _ in range(rng.randrange(1, 200))),
             lambda: "".join(chr(rng.choice([rng.randrange(1, 0xD7FF), rng.randrange(32, 127), 0x1F600])) for _ in range(50)),
             lambda: "".join(rng.choice(" ▁a") for _ in range(rng.randrange(1, 60))),
             lambda: "".join(rng.choice("aie") for _ in range(rng.randrange(1, 60))),
             lambda: "".join(rng.choice(["the", "ing", "ed", " ", "\n", "1", "2024", "==", "--", "<s>"]) for _ in range(60)))
    return [rng.choice(kinds)() for _ in range(n)] + ["", "\0", "a\0b", " " * 500, "=" * 999, "<0x41></s>", "\U0010FFFF"]


def test_merging_equals_the_library():
    model, texts = _model(), _texts(3000)
    want = [len(x) for x in model.library.encode(texts)]
    assert token_counts.count_texts(model, texts).tolist() == want
    assert token_counts.count_texts(model, texts, slice_size=7).tolist() == want
    assert token_counts.count_texts(model, texts[:300], long=1, slice_size=50).tolist() == want[:300]


def test_merging_of_one_long_pre_token():
    model, rng = _model(), random.Random(2)
    for text in ("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60_000)), " " * 9_000,
                 "".join(rng.choice("日本語の中国") for _ in range(20_000))):
        assert token_counts.count_texts(model, [text])[0] == len(model.library.encode(text))


def test_token_counts_of_documents(spark):
    library = _model().library
    docs = common.table(spark, SF_SMALL, "documents")
    want = {r.doc_id: (len((r.text or "").encode()), len(library.encode(r.text or ""))) for r in docs.collect()}
    got = queries.op11_token_counts(spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want and len(got) == len(want)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got) and any(r.over_limit for r in got)


def test_token_counts_of_messy_rows(spark):
    texts = [(1, None), (2, ""), (3, " "), (None, "no id"), (4, "twice"), (4, "twice"), (5, "x" * 200_000), (6, "é日\U0001F600\x01")]
    docs = spark.createDataFrame([r + PAD for r in texts], f"doc_id bigint, text string, {CLASH}")
    library = _model().library
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096) for i, t in texts)
    assert Counter(map(tuple, token_counts.token_counts(docs, spark, MODEL).collect())) == want
    assert token_counts.token_counts(docs.limit(0), spark, MODEL).count() == 0


def test_a_model_that_is_not_bpe_is_refused(monkeypatch):
    with open(MODEL, "rb") as f:
        proto = f.read()
    model = token_counts.load(proto)
    monkeypatch.setattr(model, "ranks", model.ranks[::-1].copy())
    with pytest.raises(ValueError):
        token_counts.checked(proto)


# --- 12: whitening -------------------------------------------------------------------------

def _usable(rows):
    out = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows
           if v is not None and v and all(c is not None and math.isfinite(c) and abs(256 * c) < 2 ** 63 for c in v)]
    size = Counter(len(v) for _, v in out)
    d = max(size, key=lambda k: (size[k], k)) if size else 0
    return [(i, v) for i, v in out if len(v) == d]


def _check_whitening(rows, got):
    used = _usable(rows)
    fit = sorted({v for _, v in used})
    x, n = np.array(fit, float), len(fit)
    sums = [sum(c) for c in zip(*fit)]
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True).reshape(len(sums), len(sums)))
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    keep = values > 1e-12 * values[0]
    k = int(keep.sum())
    assert len(got) == k * len(used) and {r.component for r in got} == set(range(1, k + 1))
    deviations = Counter((i, c, sum((n * a - s) ** 2 for a, s in zip(v, sums))) for i, v in used for c in range(1, k + 1))
    assert Counter((r.vec_id, r.component, int(r.deviation_exact)) for r in got) == deviations
    assert all(r.n == n and r.identity_error <= 1e-4 for r in got)
    assert all((r.deviation is None) == (int(r.deviation_exact) >= 2 ** 63) for r in got)
    for c in range(k):
        mine = [r for r in got if r.component == c + 1]
        assert all(abs(r.explained - values[c] / np.trace(np.cov(x.T, bias=True).reshape(len(sums), -1))) <= 1e-9 for r in mine)
        want = sorted((i, float((np.array(v, float) - x.mean(0)) @ vectors[:, c] / math.sqrt(values[c]))) for i, v in used)
        for sign in (1, -1):
            here = sorted((r.vec_id, sign * r.whitened) for r in mine)
            if all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-6 for a, b in zip(here, want)):
                break
        else:
            raise AssertionError(f"component {c + 1}")


def test_whitening_equals_dense_eigenvectors(spark):
    rows = [(r.vec_id, r.embedding) for r in common.table(spark, SF_MID, "embeddings").collect()]
    _check_whitening(rows, queries.op12_whiten_embeddings(spark, SF_MID).collect())


def test_whitening_of_messy_rows(spark):
    rng = random.Random(4)
    scale = [3.0, 1.0, 0.4, 0.1, 0.02]
    rows = [(i, [rng.gauss(0, s) for s in scale]) for i in range(200)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (900, rows[3][1]), (901, None), (902, []), (903, [1.0, None, 0, 0, 0]),
             (904, [math.nan, 1.0, 0, 0, 0]), (905, [math.inf, 1.0, 0, 0, 0]), (906, [1.0, 2.0]), (907, [-0.0] * 5),
             (908, [1e300, 0, 0, 0, 0.0]), (909, [2.0 ** 40, 0, 0, 0, 0.0])]
    rows = [(i, v and [c if c is None else float(c) for c in v]) for i, v in rows]
    frame = spark.createDataFrame([(i, v) + PAD for i, v in rows], f"vec_id bigint, embedding array<double>, {CLASH}").repartition(3)
    got = whitening.whiten_table(frame, spark).collect()
    used = _usable(rows)
    assert {r.vec_id for r in got} == {i for i, _ in used} and 909 in {r.vec_id for r in got}
    _check_whitening([r for r in rows if r[0] != 909],
                     whitening.whiten_table(frame.where("vec_id <> 909"), spark).collect())
    assert whitening.whiten_table(frame.limit(0), spark).count() == 0
    assert whitening.whiten_table(frame.where("vec_id = 7"), spark).count() == 0  # nothing varies
    assert whitening.whiten_table(frame, spark).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"]


@pytest.mark.parametrize("kind", range(4))
def test_leading_components(kind):
    rng = np.random.default_rng(kind)
    for d in (1, 2, 3, 17, 64):
        a = rng.standard_normal((300, d)) * (10.0 ** -np.arange(d).clip(0, 5) if kind == 1 else 1.0)
        m = np.eye(d) * 3 if kind == 2 else np.cov(a.T, bias=True).reshape(d, d)
        if kind == 3 and d > 2:  # two equal leading eigenvalues
            q, _ = np.linalg.qr(rng.standard_normal((d, d)))
            m = q @ np.diag([5.0, 5.0, *np.linspace(1, 2, d - 2)]) @ q.T
            m = (m + m.T) / 2
        k = min(4, d)
        values, vectors = whitening.leading_components(m, k)
        assert np.allclose(values, np.linalg.eigvalsh(m)[::-1][:k], rtol=0, atol=1e-13 * max(1, np.abs(m).max()))
        assert np.abs(m @ vectors - vectors * values).max() < 1e-12
        assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-10


# --- 13: ranked search -----------------------------------------------------------------------

def _terms(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", folded)


def _search(docs, items, k=10):
    words = [Counter(_terms(t)) for _, t in docs]
    n = sum(bool(w) for w in words)
    length = sum(sum(w.values()) for w in words)
    df = Counter(t for w in words for t in w)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), w in zip(docs, words):
            m = 25 + 75 * sum(w.values()) * n // length if length else 0
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * w[t] // (1000 * w[t] + 8 * m))
                    for t, q in Counter(_terms(text)).items() if w[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -s) for i, (s, none, doc) in enumerate(sorted(scored)[:k])]
    return Counter(out)


@pytest.mark.parametrize("part,step,max_terms", [(10 ** 6, 0.6, 10 ** 6), (300, 0.9, 150), (2_000, 0.1, 1)])
def test_search_of_messy_rows_equals_brute_force(spark, part, step, max_terms):
    rng = random.Random(9)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(400)]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60)))) for i in range(300)]
    docs += [(5, docs[5][1]), (5, docs[5][1]), (None, docs[5][1]), (301, None), (302, ""), (303, "!!! ..."), (304, "W1 w1, W2"),
             (305, "Straße ÉTÉ 日本"), (306, " ".join(rng.choice(vocabulary) for _ in range(30_000)))]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 25)))) for i in range(25)]
    items += [(3, items[3][1]), (90, None), (91, ""), (92, "w1"), (93, "unseen"), (94, "STRASSE straße Été ÉTÉ 日本"), (None, "w2 w2 w3"),
              (95, " ".join(rng.choice(vocabulary) for _ in range(3_000)))]
    d = spark.createDataFrame([r + PAD for r in docs], f"doc_id bigint, text string, {CLASH}").repartition(3)
    q = spark.createDataFrame([r + PAD for r in items], f"item_id bigint, text string, {CLASH}")
    if max_terms == 1:  # a block an item
        items = items[::7]
        q = spark.createDataFrame([r + PAD for r in items], q.schema)
    got = ranked_search.search(d, q, spark, part_postings=part, step=step, max_terms=max_terms)
    assert Counter(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect())) == _search(docs, items)
    if part == 300:
        assert ranked_search.search(d.limit(0), q, spark).count() == 0
        assert ranked_search.search(d, q.limit(0), spark).count() == 0
        assert ranked_search.search(d.where("text is null"), q, spark).count() == 0


def test_search_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{name}.parquet')")
    want = Counter(con.sql(queries.OP13_SQL).fetchall())
    assert Counter(map(tuple, queries.op13_ranked_search(spark, SF_SMALL).collect())) == want and len(want) > 0


def test_nra_bounds_and_ties():
    """One part: all scores at or above the k-th, exact, for random lists with many ties."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        n, t, k = int(rng.integers(1, 80)), int(rng.integers(1, 12)), int(rng.integers(1, 12))
        held = rng.random((t, n)) < rng.random((t, 1))
        term, doc = np.nonzero(held)
        impact = rng.integers(1, 6, len(term))
        factors = rng.integers(1, 5, t)
        lists = ranked_search.Lists(term, doc, impact, t, np.arange(n))
        scores = np.zeros(n, np.int64)
        np.add.at(scores, doc, factors[term] * impact)
        before = rng.integers(1, 30, int(rng.integers(0, k + 1)))
        found, got = ranked_search.nra(lists, np.arange(t), factors, before, k)
        assert (got == scores[found]).all() and len(set(found.tolist())) == len(found)
        every = np.sort(np.concatenate([scores[scores > 0], before]))[::-1]
        bar = every[k - 1] if len(every) >= k else 1
        assert set(np.flatnonzero(scores >= bar)) <= set(found.tolist())
