"""Merkle manifest, chosen-path join and tokenizer alignment against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestrata.llm import chosen_path, gru, merkle, token_alignment
from lodestrata.llm.catalog import QUERIES
from tests.llm import plain

ODD = [(901, None), (902, ""), (903, " \n"), (904, "One"), (904, "One"), (None, "No id"), (905, "A b " * 9_000)]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# --- manifest ---

MERKLE = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def source_rows(n_by_source):
    rows, k = [], 0
    for source, n in n_by_source:
        for _ in range(n):
            rows.append((k * 7 % 1009, f"Text Number {k} É", source))
            k += 1
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        [("a", 1)],
        [("a", 300), (None, 17), ("é", 16), ("B", 1), ("", 2)],
        [(f"s{i}", 1 + i % 3) for i in range(40)],
        [("a", 4_200), ("b", 256), ("c", 257)],
    ],
    ids=["one", "mixed", "many sources", "four levels"],
)
def test_manifest_equals_plain(spark, sizes):
    rows = source_rows(sizes) + ([(i, t, "odd") for i, t in ODD] if len(sizes) > 1 else [])
    docs = plain.documents(spark, rows)
    want = plain.merkle([tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    assert rows_of(merkle.tampered(docs), *MERKLE) == sorted(want, key=str)
    assert len({w[-1] for w in want}) == 2 or len(sizes) == 1


def test_manifest_of_nulls_and_of_nothing(spark):
    docs = plain.documents(spark, [(None, None, None)] * 3 + [(2, "x", None)])
    null = docs.select(*[F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
    for df in (docs, null, docs.unionAll(null)):
        want = plain.merkle([tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()])
        assert rows_of(merkle.tampered(df), *MERKLE) == sorted(want, key=str)
    empty = merkle.build(docs.limit(0))
    assert empty.root is None and merkle.proofs(empty).count() == 0
    assert merkle.tampered(docs.limit(0)).count() == 0


def test_proofs_lead_every_leaf_to_the_root(spark):
    docs = plain.documents(spark, source_rows([("a", 600), ("b", 40)]))
    manifest = merkle.build(docs)
    # of three levels and a top, only every second is stored
    assert [level.where("tree = 'sa'").count() for level in manifest.sources.levels] == [600, 3, 1]
    proved = merkle.proofs(manifest).withColumn("to", merkle.fold(F.col("leaf"), F.col("path")))
    assert {r.to for r in proved.collect()} == {manifest.root}
    wrong = merkle.fold(F.sha2(F.lit("other"), 256), F.col("path"))
    assert manifest.root not in {r.to for r in proved.withColumn("to", wrong).collect()}
    # any other column changes the root
    other = merkle.build(docs.withColumn("lang", F.when(F.col("doc_id") == 7, F.lit("de")).otherwise(F.col("lang"))))
    assert other.root != manifest.root


def test_manifest_does_not_depend_on_layout(spark):
    docs = plain.documents(spark, source_rows([("a", 900), ("b", 33)]))
    roots = {merkle.build(docs.repartition(n)).root for n in (1, 7)}
    assert len(roots) == 1


# --- chosen paths ---


def family(rng, words, n, edits):
    base = [rng.choice(words) for _ in range(200)]
    out = []
    for _ in range(n):
        own = list(base)
        for at in rng.sample(range(200), edits):
            own[at] = rng.choice(words)
        out.append(" ".join(own))
    return out


def copies(rows):
    return sorted(((d, n, c, d == c) for d, n, c in rows), key=str)


COPIES = ("doc_id", "n_shingles", "component_id", "kept")


@pytest.mark.parametrize(("small", "middle", "chunk"), [(64, 8_192, 1 << 19), (4, 8, 2_000)])
def test_near_copies_equal_plain(spark, monkeypatch, small, middle, chunk):
    monkeypatch.setattr(chosen_path, "SMALL", small)
    monkeypatch.setattr(chosen_path, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(chosen_path, "CHUNK", max(chunk >> 7, 16))
    monkeypatch.setattr(chosen_path, "DEPTH", 3)
    monkeypatch.setattr(chosen_path, "MIDDLE", middle)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3_000)]
    shared = " ".join(rng.choice(words) for _ in range(60))
    texts = []
    # one large group of close copies, groups around the limit, and a passage many documents share
    for n, edits in [(70, 2), (9, 4), (8, 6), (8, 7), (8, 9), (3, 0)]:
        texts += family(rng, words, n, edits)
    texts += [f"{shared} {' '.join(rng.choice(words) for _ in range(rng.choice([5, 20, 60])))}" for _ in range(60)]
    texts += ["a b c d", "A B C  d", "a b c", "a b", "a b c d e", "a b c d e f g h i j k l m n", "b c d e f g h i j k l m n"]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [r for r in ODD if r[0] is not None]
    got = rows_of(chosen_path.near_copies(plain.documents(spark, rows)), *COPIES)
    assert got == copies(plain.components(rows, 4, 80))


def test_near_copies_without_ids_and_of_nothing(spark):
    rows = [(None, "one two three four five"), (None, "one two three four five"), (None, None), (3, "x y"), (None, "x y")]
    docs = plain.documents(spark, rows)
    got = rows_of(chosen_path.near_copies(docs), *COPIES)
    assert got == sorted([(None, 2, None, True)] * 2 + [(None, 0, None, True), (3, 1, 3, True), (None, 1, 3, False)], key=str)
    assert chosen_path.near_copies(docs.limit(0)).count() == 0


def test_sketch_estimates_are_near(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(900)]
    a, b = family(rng, words, 2, 5)
    import numpy as np
    import pyarrow as pa

    (_, _, key, first), = chosen_path._sets(pa.array([a, b]), 4)
    sketch = chosen_path._sketches(key, first)
    one, two = set(key[: first[1]]), set(key[first[1] :])
    exact = len(one & two) / len(one | two)
    assert abs(float(chosen_path._estimates(sketch[0], sketch[1])) - exact) < 0.1
    assert np.all(chosen_path._class_of(key, first) != 0)


# --- alignment ---

ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def pair():
    return token_alignment.load()


def strange_texts(rng, n):
    bits = ["word", "Word", "don't", "I'll", " ", "  ", "\n", "\t", "1234", "3.14", "é", "漢字", "ß", "'s", "!", "...",
            "<|endoftext|>", "<s>", "</s>", "<0x41>", "🙂", " ", " ", "\x1c", "x" * 70, "-", "_", "‘quote’", "٣", "é"]
    return ["".join(rng.choice(bits) + rng.choice(["", " ", ""]) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_alignment_equals_plain(spark, monkeypatch, pair):
    monkeypatch.setattr(token_alignment, "BLOCK_LINKS", 300)
    monkeypatch.setattr(token_alignment, "AT_ONCE", 2_000)
    rng = random.Random(3)
    texts = strange_texts(rng, 150)
    texts += ["▁ sign", "a ▁b", " ", "  x  ", "x", "the the the", "the the the", "Hello, world. Next word", "word " * 3_000]
    rows = list(enumerate(texts)) + ODD + [(5_000 + i, texts[0]) for i in range(40)] + [(None, texts[1])]
    got = rows_of(token_alignment.measures(plain.documents(spark, rows), pair), *ALIGNED)
    assert got == sorted(plain.alignment(rows, pair.opened()), key=str)
    by_id = {r[0]: r for r in got}
    assert by_id[150][1:] == (0, 0, 0, 0, 0, 0, "") and by_id[0][1] > 0


def test_alignment_groups_and_counts(spark, pair):
    docs = plain.documents(spark, [(1, "tokenizers align"), (2, "tokenizers align"), (3, None)])
    found = token_alignment.align(token_alignment.distinct_texts(docs), pair).collect()
    assert len(found) == 1 and found[0].copies == 2
    aligner = pair.opened()
    groups = [[list(map(int, side.split(","))) for side in g.split("|")] for g in found[0].groups.split(";")]
    for a, b in groups:
        assert b"".join(aligner.bytes_a[i] for i in a) == b"".join(aligner.bytes_b[i] for i in b)
    assert len(groups) == found[0].n_groups
    assert token_alignment.measures(docs.limit(0), pair).count() == 0
    assert rows_of(token_alignment.measures(docs.where("doc_id = 3"), pair), *ALIGNED) == [(3, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_refuses_other_tokenizers(tmp_path):
    other = tmp_path / "words.json"
    other.write_text('{"pre_tokenizer": {"type": "Whitespace"}}')
    with pytest.raises(ValueError, match="byte-level"):
        token_alignment.load(a=str(other))


@pytest.mark.parametrize("name", ["op12_minhash_dedup", "op13_tokenizer_alignment"])
def test_queries_equal_plain(spark, sf_dir, pair, name):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    if name == "op12_minhash_dedup":
        assert rows_of(QUERIES[name](spark, sf_dir), *COPIES) == copies(plain.components(rows, 4, 80))
    else:
        assert rows_of(QUERIES[name](spark, sf_dir), *ALIGNED) == sorted(plain.alignment(rows, pair.opened()), key=str)


def test_sets_of_a_chunk_are_tested_together():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, n)).astype(np.uint64) for n in rng.integers(1, 70, 80)]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    key = np.concatenate(sets)
    shared = chosen_path._Shared(key[: first[30]], first[:31], key, first)
    for j in (np.arange(80), np.arange(5, 9), np.array([79])):  # all, and few enough to be picked out
        for i in range(30):
            wanted = [chosen_path._similar(sets[i], sets[x], 70) for x in j]
            assert shared.similar(i, j, 70).tolist() == wanted


def test_estimates_count_bins():
    rng = np.random.default_rng(4)
    a, b = (rng.integers(0, 3, (7, chosen_path.BINS)).astype(np.uint8) for _ in range(2))
    same, either = ((a == b) & (a > 0)).sum(1), ((a > 0) | (b > 0)).sum(1)
    assert (chosen_path._estimates(a, b) == same / either).all()
    assert (chosen_path._estimates(a[:, None], b[None])[2, 2] == chosen_path._estimates(a, b)[2]).all()
    assert chosen_path._estimates(a * 0, b * 0).tolist() == [0] * 7


def test_gradients_of_the_network():
    rng = np.random.default_rng(6)
    model = gru.create(np.array([9.0, 5, 4, 2, 1, 1]), 3.0, hidden=4)
    for n in gru.NAMES:
        x = getattr(model, n)
        setattr(model, n, rng.normal(0, 0.3, x.shape))
    words, start = rng.integers(0, 7, (5, 3)), 7
    before = np.vstack([np.full(3, start), words[:-1]])
    before[3, 1] = start  # a text that ends within the window

    def loss():
        h, total = np.zeros((3, 4)), 0.0
        E, U = gru._by_gate(model.E), gru._by_gate(model.U)
        for t in range(5):
            h[before[t] == start] = 0
            h = gru._step(E.take(before[t], axis=1), np.matmul(h, U), h)[2]
            total -= model.logs(words[t], h).sum()
        return total / words.size

    found = gru._window(model, words, before, np.zeros((3, 4), np.float32), start)[1]
    rows, sums = found["E"]
    assert rows.tolist() == np.unique(before).tolist()
    found["E"] = np.zeros_like(model.E)
    found["E"][rows] = sums
    for n in gru.NAMES:
        weights = getattr(model, n)
        for at in np.ndindex(weights.shape):
            kept, ends = weights[at], []
            for step in (1e-5, -1e-5):
                weights[at] = kept + step
                ends.append(loss())
            weights[at] = kept
            assert abs((ends[0] - ends[1]) / 2e-5 - found[n][at]) < 1e-3, (n, at)
