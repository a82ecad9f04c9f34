"""Every registered query over one small corpus, against its SQL or a plain version of its contract."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from wakeline.llm import bpe, hmm_lm, media_columns, queries, quality_classifier as qc, secret_scan

from .conftest import SCHEMA, edge_rows, prose
from .test_near import brute_lines, brute_near, family
from .test_quality import brute_rules
from .test_texts import check_bins


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(12)
    texts = [t for i, t, *_ in edge_rows() if i is not None and len(t or "") < 1000]
    texts += [t.replace(" ", "\n", 2) for s in range(3) for t in family(60 + s, 4, 90, 2)]
    texts += [prose(400 + i, r.randint(3, 120)) + r.choice(["", " password = hunter22", " AKIA" + "Q" * 20, " <|endoftext|> é😀"]) for i in range(40)]
    texts += [" ".join(w + "%#" for w in prose(600 + i, 60).split()) for i in range(20)]
    rows = [(i + 1, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int("%#" not in (t or "")), 0) for i, t, *_ in rows if i % 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    hosts = ["a.example.com", "EXAMPLE.net", "b.spam-farm.example.org", "x.y.z", "com", "spam-farm.example.org", "", *[f"h{i}.org" for i in range(60)]]
    pages = [(i, f"{r.choice(['http://', 'https://', ''])}{r.choice(hosts)}{r.choice(['', '/', '/en/x', '/es/y?q', '/fr/#z'])}", "<p>") for i in range(400)] + [(400, None, None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return path, rows


def run(spark, corpus, name):
    return queries.QUERIES[name](spark, corpus[0])


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, corpus, name):
    import duckdb

    db = duckdb.connect()
    for table in ("documents", "labels", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{corpus[0]}/{table}.parquet/*.parquet'")
    want = db.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = run(spark, corpus, name)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_op1_digests_of_kept_lines(spark, corpus):
    want = brute_lines(corpus[1])
    lines = {i: sum(bool(x.encode().split()) for x in (t or "").split("\n")) for i, t, *_ in corpus[1]}
    for r in run(spark, corpus, "op1_fuzzy_lines").collect():
        assert r.kept_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
        assert (r.n_lines, r.n_kept) == (lines[r.doc_id], sum(bool(x.encode().split()) for x in want[r.doc_id].split("\n")))


def test_op2_columns(spark, corpus):
    got = {r.doc_id: r for r in run(spark, corpus, "op2_quality_rules").collect()}
    for i, t, *_ in corpus[1]:
        x = got[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == brute_rules(t)


def plain_nb_svm(rows, labels):
    """A plain version with dictionaries: ratios of all learning rows, weights of a hinge loss by coordinate descent."""
    learn = [(set(qc.features(t).tolist()), 1 if labels[i] else -1) for i, t, *_ in rows if i in labels and zlib.crc32(str(i).encode()) % 4 != 2]
    count = {y: Counter(f for found, z in learn if z == y for f in found) for y in (1, -1)}
    total = {y: sum(count[y].values()) + qc.FEATURES for y in count}
    ratio = lambda f: math.log((count[1][f] + 1) / total[1]) - math.log((count[-1][f] + 1) / total[-1])
    data = []
    for found, y in learn:
        v = {f: ratio(f) for f in found}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        data.append(({f: x / norm for f, x in v.items()}, y))
    pos, neg = sum(y > 0 for _, y in learn), sum(y < 0 for _, y in learn)
    w, bias, alpha = Counter(), 0.0, [0.0] * len(data)
    for _ in range(30):
        for k, (v, y) in enumerate(data):
            cost = qc.COST * (1.0 if y > 0 else max(1.0, pos / neg))
            square = sum(x * x for x in v.values()) + 1
            new = min(max(alpha[k] - (y * (sum(w[f] * x for f, x in v.items()) + bias) - 1) / square, 0.0), cost)
            for f, x in v.items():
                w[f] += (new - alpha[k]) * y * x
            bias += (new - alpha[k]) * y
            alpha[k] = new

    def margin(text):
        v = {f: ratio(f) for f in qc.features(text).tolist()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return sum(w[f] * x for f, x in v.items()) / norm + bias

    return margin


def test_op3_agrees_with_a_plain_version(spark, corpus):
    path, rows = corpus
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    margin = plain_nb_svm(rows, labels)
    got = {r.doc_id: r for r in run(spark, corpus, "op3_nb_svm_quality").collect()}
    assert len(got) == len(rows)
    plain = {i: margin(t) for i, t, *_ in rows}
    for i, _, *_ in rows:
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    # The score is a logistic of the margin: slope and shift aside, both machines give the same margins.
    logit = np.array([math.log(got[i].score / (1 - got[i].score)) for i, *_ in rows])
    assert np.corrcoef(logit, [plain[i] for i, *_ in rows])[0, 1] > 0.98
    sure = [i for i, *_ in rows if abs(plain[i]) > 0.3]
    good = [got[i].score for i in sure if plain[i] > 0]
    bad = [got[i].score for i in sure if plain[i] < 0]
    assert len(good) > 20 and len(bad) > 10 and min(good) > max(bad)


def test_op4_payloads(spark, corpus):
    got = {r.doc_id: r for r in run(spark, corpus, "op4_webp_columns").collect()}
    same = {}
    for i, t, *_ in corpus[1]:
        data = (t or "").encode()
        payload = data + b"\xff" * (max(576, -(-len(data) // 576) * 576) - len(data))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        stored = media_columns.store(payload)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert same.setdefault(payload, (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)


def test_op6_columns(spark, corpus):
    rows = [(i, hmm_lm.tokenize(t)) for i, t, *_ in corpus[1]]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in run(spark, corpus, "op6_hmm_lm").collect()}
    for i, t in rows:
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        assert r.score < 0


def test_op7_components(spark, corpus):
    got = run(spark, corpus, "op7_fast_sketch_dedup").collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_near(corpus[1])
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_op8_digests(spark, corpus):
    got = {r.doc_id: r for r in run(spark, corpus, "op8_secret_ledger").collect()}
    for i, t, *_ in corpus[1]:
        spans = secret_scan.find_secrets(t or "")
        base = [x for x in spans if x[1] < 3]
        text = lambda some: ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in some)
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in spans) for n in range(3))
        assert (r.base_sha256, r.spans) == (hashlib.sha256(text(base).encode()).hexdigest(), text(spans))
    assert any(r.n_assign for r in got.values()) and any(r.n_access for r in got.values())


def test_op9_digests(spark, corpus):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    got = {r.doc_id: r for r in run(spark, corpus, "op9_bpe_transducer").collect()}
    for i, t, *_ in corpus[1]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want


def test_op10_bins(spark, corpus):
    check_bins(corpus[1], run(spark, corpus, "op10_best_fit_packing").collect(), 2048)
