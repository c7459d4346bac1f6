"""URL filter, top-k, Jaccard join, sharding, language model, toxicity, pipeline."""

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestrata.llm import (
    components,
    gru,
    jaccard_join,
    lm_score,
    pii,
    sharding,
    topk,
    toxicity,
    url_filter,
)
from lodestrata.llm.catalog import ORACLES, QUERIES
from tests.llm import plain

ODD = [(901, None), (902, ""), (903, " \n"), (904, "one"), (904, "one"), (None, "no id"), (905, "a b " * 9_000)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    cursor = db.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(columns).collect()), key=str)
    assert got == sorted(cursor.fetchall(), key=str)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


# --- URLs ---

URLS = [
    (1, "https://a.example.net/en/x", "example.net/en/", "allow"),
    (2, "https://a.example.net/EN/x", "net/", "block"),
    (3, "http://NET/x", "net/", "block"),
    (4, "http://net", None, "allow"),
    (5, "http://a.net?x=net/", None, "allow"),
    (6, "http://badexample.com/de/", None, "allow"),
    (7, "http://x.example.com/de/#t", "example.com/de/", "block"),
    (8, "http://a.org/fr/casino", "org/fr/", "allow"),
    (9, "http://a.de/Casino?x", None, "block"),
    (10, "http://a.de/casinos", None, "allow"),
    (11, None, None, "allow"),
    (12, "no scheme net/", None, "allow"),
    (12, "no scheme net/", None, "allow"),
    (None, "http://b.net/\n", "net/", "block"),
    (13, "", None, "allow"),
]


def test_url_verdicts(spark):
    pages = spark.createDataFrame(
        [(i, u, "r", "h") for i, u, _, _ in URLS], "page_id long, url string, rule string, token string"
    )
    rows = url_filter.filter_urls(pages).collect()
    got = sorted(((r.page_id, r.rule, r.verdict) for r in rows), key=str)
    assert got == sorted(((i, rule, v) for i, _, rule, v in URLS), key=str)
    kept = url_filter.keep_allowed(pages)
    assert kept.columns == pages.columns
    assert kept.count() == sum(v == "allow" for *_, v in URLS)
    assert url_filter.filter_urls(pages.limit(0)).count() == 0
    none = url_filter.filter_urls(pages, [])
    assert {r.verdict for r in none.collect()} == {"allow"} and none.count() == len(URLS)


def test_rules_are_filed_under_their_rarest_token(spark):
    tokens = spark.createDataFrame([("net",)] * 5 + [("example",)] * 2 + [("en",)] * 3, "token string")
    index = url_filter.rule_index(tokens, [url_filter.host_rule("allow", "example.net/en/")])
    assert [r.token for r in index.collect()] == ["example"]


def test_ties_go_to_block(spark):
    rules = [url_filter.host_rule(a, "x.net/") for a in ("allow", "block")]
    pages = spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")
    assert url_filter.filter_urls(pages, rules).first().verdict == "block"


# --- top-k ---


def _scores(rows, k, every=50):
    ok = [(i, np.floor(256 * np.array(v, float))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in ok:
        if q % every:
            continue
        found = []
        for i, y in ok:
            if i != q:
                n = min(len(x), len(y))
                found.append((-int(x[:n] @ y[:n]), i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 4_096])
def test_top_k_equals_plain(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(300)]
    rows += [(300, rows[0][1]), (350, rows[0][1]), (351, rows[0][1])]  # ties
    rows += [(400, None), (401, []), (450, [1.0, None]), (500, [float("nan")] * 8), (None, [1.0] * 8), (550, [0.5, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    df = df.repartition(3)
    got = sorted(tuple(r) for r in topk.top_k(df, 5).collect())
    assert got == _scores(rows, 5)


def test_top_k_of_repeated_query_ids(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(1, 40)] + [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (100, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df, 5).collect()
    # each row with the id asks for itself
    assert sum(r.query_id == 50 for r in found) == 10 and sum(r.query_id == 100 for r in found) == 5


def test_top_k_of_chunks_and_of_nothing(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i * 10, rng.normal(0, 1, 4).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(topk, "CHUNK", 3)
    monkeypatch.setattr(topk, "AT_ONCE", 2)
    assert sorted(tuple(r) for r in topk.top_k(df, 70).collect()) == _scores(rows, 70)
    assert topk.top_k(df.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 4])
def test_top_k_beside_many_copies_of_a_query(spark, parts):
    # clusters stored one after the other; so many copies that all lists are read to the end
    rng = np.random.default_rng(3)
    rows = []
    for cluster in range(4):
        centre = rng.normal(0, 1, 8)
        own = [centre + rng.normal(0, 0.05, 8) for _ in range(150)] + [centre] * 100
        rows += [(cluster * 250 + i, (v / np.sqrt(v @ v)).tolist()) for i, v in enumerate(own)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.repartitionByRange(parts, "vec_id")
    assert sorted(tuple(r) for r in topk.top_k(df, 5).collect()) == _scores(rows, 5)


# --- Jaccard join ---


def _near_copies(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3_000)]
    line = " ".join(rng.choices(vocabulary, k=12))
    rows, number = [], 0
    for size in (1, 3, 5, 30, 120, 400):
        for _ in range(6):
            base = rng.choices(vocabulary, k=size)
            for copy in range(rng.choice([1, 2, 5, 90 if size == 30 else 4])):
                w = list(base)
                for _ in range(rng.randrange(0, max(2, size // 25 + 1)) if copy else 0):
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
                text = " ".join(w) + ("\n" + line if rng.random() < 0.4 else "")
                rows.append((number, text.upper() if copy % 4 == 1 else text))
                number += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hub,tokens", [(64, 50_000), (2, 60)])
def test_components_equal_plain(spark, monkeypatch, hub, tokens):
    monkeypatch.setattr(jaccard_join, "HUB_FROM", hub)
    monkeypatch.setattr(jaccard_join, "GROUP_TOKENS", tokens)
    rows = _near_copies()
    found = jaccard_join.join_components(plain.documents(spark, rows))
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect())
    assert got == sorted(plain.components(rows))


def test_join_of_odd_rows(spark):
    docs = plain.documents(spark, ODD)
    rows = jaccard_join.join_components(docs).collect()
    assert len(rows) == len(ODD)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in rows}
    assert {(901, 0, 901), (902, 0, 902), (903, 0, 903), (904, 1, 904), (None, 1, None)} <= got
    assert jaccard_join.join_components(docs.limit(0)).count() == 0
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(ODD) - 1


def test_one_of_each_component_stays(spark):
    rows = _near_copies(2)
    kept = jaccard_join.keep_one(plain.documents(spark, rows), size=5, percent=80)
    want = {c for _, n, c in plain.components(rows, 5, 80)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_components_of_a_chain_and_of_nothing(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(90, 80), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(chain).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 80: 80, 90: 80}
    assert components.components(chain.limit(0)).count() == 0


# --- sharding ---


def test_shards_are_even_and_mixed(spark):
    rng = random.Random(1)
    rows = [(i, "t" * rng.randrange(9), "hot" if i % 3 else f"s{i % 7}") for i in range(2_000)]
    rows += [(d, t, None) for d, t in ODD] + [(7, "t", "hot")]
    out = sharding.shard(plain.documents(spark, rows), shards=16).collect()
    assert len(out) == len(rows)
    by_shard: dict = {}
    for r in out:
        by_shard.setdefault(r.shard, []).append(r)
    sizes = [len(v) for v in by_shard.values()]
    assert len(by_shard) == 16 and max(sizes) - min(sizes) <= 1
    for own in by_shard.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    hot = [sum(r.source == "hot" for r in v) for v in by_shard.values()]
    assert max(hot) - min(hot) <= 4
    assert all(r.size >= 1 and r.law == "rows" and r.grown_shard is None for r in out)
    assert sharding.shard(plain.documents(spark, [])).count() == 0
    few = sharding.shard(plain.documents(spark, [(1, "a"), (2, "b")])).collect()
    assert len({r.shard for r in few}) == 2 and {r.slot for r in few} == {0}


# --- language model ---


def test_scores_equal_plain_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + [r for r in ODD if r[0] is not None]
    df = plain.documents(spark, rows)
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    got = lm_score.score(df, rest != 2).collect()
    want = plain.base_scores(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id == 904:
            continue  # twice there
        n_tokens, n_known, total, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    known = [r for r in got if r.doc_id < 900]
    # on what it has learned from and on held-out texts alike it beats the plain counts
    for held in (True, False):
        own = [r for r in known if plain.held_out(r.doc_id, 7, 2) == held]
        assert sum(r.score for r in own) > sum(r.base_score for r in own) * (1.02 if held else 1)


def test_language_model_of_odd_tables(spark):
    docs = plain.documents(spark, ODD)
    never = lm_score.score(docs, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in never} == {(0, 0)} and len(never) == len(ODD)
    assert lm_score.score(docs.limit(0), F.lit(True)).count() == 0


def test_network_learns_from_every_training_document(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices("abcdefghij", k=30))) for i in range(1_500)]

    def of_the_last(rows):
        found = lm_score.score(plain.documents(spark, rows), F.col("doc_id") < 1_499)
        return found.where("doc_id = 1499").first().score

    want = of_the_last(rows)
    assert of_the_last(rows) == want
    for i in (1, 400, 800, 1_498):
        # the same counts in another order
        other = [(d, " ".join(sorted(t.split())) if d == i else t) for d, t in rows]
        assert of_the_last(other) != want, i


def test_lm_training_is_the_same_at_any_size(spark):
    texts = [f"a b c {i % 7} d e {i % 3}" for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    blocks = lm_score._blocks(docs, F.lit(True)).localCheckpoint()
    key, _ = lm_score._shortlist(blocks, 4)
    counts = np.full(len(key), 4e6)  # the tail is empty for both numbers of tokens
    few, many = (lm_score.fit(blocks, key, counts, n) for n in (1_000_000, 3_000_000))
    assert np.array_equal(gru.packed(few, gru.fresh(few)), gru.packed(many, gru.fresh(many)))


def test_weights_are_averaged_by_tokens(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "FAN", 2)
    rows = [(p, float(p + 1), np.full(3, p, np.float32).tobytes()) for p in range(7)]
    found = spark.createDataFrame(rows, "part long, n double, flat binary")
    few = lm_score._averaged(found, 7).toArrow()
    assert few.num_rows <= 2
    total, flat = lm_score._mean(few)
    assert total == 28
    assert flat == pytest.approx(np.full(3, sum(p * (p + 1) for p in range(7)) / 28))


def test_network_sums_to_one_and_carries_its_state():
    counts = np.array([50.0, 20, 10, 5, 5, 2, 1])
    model = gru.create(counts, 7.0)
    rng = np.random.default_rng(0)
    for name in ("A", "W"):
        setattr(model, name, rng.normal(0, 1, getattr(model, name).shape).astype(np.float32))
    h = rng.normal(0, 1, (1, model.hidden)).astype(np.float32)
    every = np.arange(8)
    logs = model.logs(every, np.repeat(h, 8, axis=0))
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-5)
    word = rng.integers(0, 8, 150)
    first = np.array([0, 0, 100, 101, 150])
    whole = model.score(word, first)
    assert model.score(word, first, window=7) == pytest.approx(whole, rel=1e-5)
    assert whole[0] == 0
    alone = [model.score(word[a:b], np.array([0, b - a]))[0] for a, b in zip(first[1:-1], first[2:], strict=True)]
    assert whole[1:] == pytest.approx(alone, rel=1e-5)


def test_network_learns_an_order():
    rng = np.random.default_rng(1)
    texts = [np.tile([0, 1, 2, 3], 30) for _ in range(30)]
    model = gru.create(np.full(4, 900.0), 0.0)
    before = model.score(texts[0], np.array([0, 120]))[0]
    gru.train(model, texts, epochs=20)
    after = model.score(np.roll(texts[0], int(rng.integers(4))), np.array([0, 120]))[0]
    assert after > 0.5 * before


# --- toxicity ---


def _evidence(text, stems=None):
    import pyarrow as pa

    lexicon = toxicity.Lexicon(toxicity.fixed_words(), stems or {})
    return float(toxicity.evidence(pa.array([text]), lexicon, toxicity.machine())[0])


def test_grammar_scores_clauses():
    assert _evidence("you are an idiot") == 1.5
    assert _evidence("an idiot, you") == 1.5
    assert _evidence("an idiot. you") == 1.0
    assert _evidence("not an idiot") == pytest.approx(0.1)
    assert _evidence("not that it matters much idiot") == 1.0
    assert _evidence("she said idiot") == pytest.approx(0.2)
    assert _evidence('the word "idiot"') == pytest.approx(0.2)
    assert _evidence("i will kill you") == 1.5
    assert _evidence("kill the lights") == 0
    assert _evidence("idiotic ideas") == 0
    assert _evidence("vequir") == 0 and _evidence("vequir", {"vequ": 0.5}) == 0.5
    assert _evidence("") == 0


def test_quotation_marks_hold_within_their_text_and_pair():
    import pyarrow as pa

    lexicon, table = toxicity.Lexicon(toxicity.fixed_words(), {}), toxicity.machine()
    texts = [
        ("you are a worthless idiot", 3.0),
        ('"you are an idiot"', 0.2),
        ('the end."', 0.0),
        ('she said "hello." you are an idiot', 1.5),
        ('the "word" you idiot', 1.5),
        ('he said "well" you idiot', 1.5),
        ('a 5" pipe\nthe word "idiot"', 0.2),
        ('this is "well" and "an idiot', 0.2),
        ('not "well", idiot', 0.1),
        ('"', 0.0),
        ("", 0.0),
        (None, 0.0),
    ]
    for text, want in texts:
        # alone, first, and after texts with and without a mark at the end
        for before in ([], ['he wrote "so"'], ['the end "'], ["no mark"], ["", '"']):
            found = toxicity.evidence(pa.array([*before, text, 'it "is'], pa.string()), lexicon, table)
            assert found[len(before)] == pytest.approx(want), (before, text)


def test_toxicity_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op10_toxicity"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    found = rows.join(labels, "doc_id").where("held_out").collect()
    assert rows.count() == 1_000
    toxic = [r for r in found if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic)
    assert not any(r.predicted for r in found if not r.toxic)
    for r in found:
        assert r.held_out == plain.held_out(r.doc_id, 3, 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)


def test_stems_are_learned(spark):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(400):
        w = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(40)]
        if i % 4 == 0:
            for _ in range(5):
                w[rng.randrange(40)] = "zoqu" + "".join(rng.choices("abcdefgh", k=3))
        rows.append((i, " ".join(w)))
        marks.append((i, int(i % 4 == 0)))
    labels = spark.createDataFrame(marks + [(None, 1), (1, None), (9_999, 1), (5, 0)], "doc_id long, toxic int")
    docs = plain.documents(spark, rows + ODD)
    model = toxicity.train(docs, labels, F.col("doc_id") < 300)
    assert any(s.startswith("zoqu") or s == "zoq" for s in model.lexicon.stems)
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    assert all(got[i] == int(i % 4 == 0) for i in range(300, 400))
    kept = toxicity.remove_toxic(docs, model)
    assert kept.schema == docs.schema and kept.count() == 300 + len(ODD)


def test_toxicity_without_labels(spark):
    docs = plain.documents(spark, ODD + [(1, "you idiot scum")])
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    got = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    assert got[1] == 1 and got[902] == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


# --- pipeline ---


def test_pipeline_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    scored = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    calm = {r.doc_id for r in scored if not r.predicted}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in calm]
    stay = {c for _, _, c in plain.components(rows, 5, 80)}
    rows = [r for r in rows if r[0] in stay]
    clean = {r[0] for r in plain.contamination(rows, benchmark) if not r[5]}
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in out) == sorted(clean)
    text = dict(rows)
    for r in out:
        assert r.round_trip and not plain.personal(r.text) and r.n_chars == len(r.text)
        if not plain.personal(text[r.doc_id]) and "[" not in r.text:
            assert r.text == text[r.doc_id]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "pii", "sentencepiece"]
    assert pii.KINDS


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, sf_dir).dtypes == docs.dtypes


def test_block_words_are_numbered_by_key_and_packed():
    rng = np.random.default_rng(2)
    key = np.append(rng.integers(0, 2**64, 50, np.uint64).take(rng.integers(0, 50, 900)), lm_score.END)
    distinct, at = lm_score._numbered(key)
    assert [x.tolist() for x in (distinct, at)] == [x.tolist() for x in np.unique(key, return_inverse=True)]
    assert distinct.dtype == np.uint64 and lm_score._numbered(key[:0])[1].tolist() == []
    words = pa.compress(at.astype(np.uint32).tobytes(), "zstd", asbytes=True)
    assert lm_score._unpacked(words, pa.array([400, 0, 501])).tolist() == at.tolist()


def test_network_looks_at_few_long_texts_in_long_windows(monkeypatch):
    """A window holds as many steps as make ROWS words, and never changes a score."""
    model = gru.create(np.array([9.0, 5, 3, 2]), 4.0)
    rng = np.random.default_rng(3)
    model.A = rng.normal(0, 1, model.A.shape).astype(np.float32)
    first = np.array([0, 300, 300, 305, 306])
    word, calls = rng.integers(0, 5, 306), []
    logs = gru.Gru.logs
    monkeypatch.setattr(gru.Gru, "logs", lambda self, w, h: calls.append(len(w)) or logs(self, w, h))
    whole = model.score(word, first)
    assert sum(calls) == 306 and len(calls) == 1
    monkeypatch.setattr(gru, "ROWS", 10)
    assert model.score(word, first) == pytest.approx(whole, rel=1e-6)
    assert max(calls[1:]) <= 10
