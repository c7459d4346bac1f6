"""Decontamination, licences, PII, SentencePiece, word scanning."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from lodestrata.llm import decontamination, licenses, pii, sentencepieces, textscan
from tests.llm import plain

ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "One"),
    (4, "One"),
    (None, "no id here"),
    (5, "Ünï cödé ÉÀ 日本 ▁ mark\r\n two  spaces "),
    (6, "x" * 70_000),
    (7, "a b " * 20_000),
]


@pytest.mark.parametrize("letters,pattern", [(textscan.SPACED, plain.SPACED), (textscan.ALNUM, plain.ALNUM)])
def test_scan_finds_the_words(letters, pattern):
    texts = [t for _, t in ODD] + ["Tab\tand\x0bmore", "7z-Über_x", "a b"]
    keys = {}
    for size in (16, 1 << 20):
        for lo, hi, found in textscan.scan_column(pa.array(texts), letters, size):
            for i in range(lo, hi):
                own = found.key[found.first[i - lo] : found.first[i - lo + 1]].tolist()
                want = plain.words(texts[i], pattern)
                assert len(own) == len(want)
                for word, key in zip(want, own, strict=True):
                    assert keys.setdefault(word, key) == key
    assert len(set(keys.values())) == len(keys)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    key = rng.integers(1, 4, 300).astype(np.uint64)
    first = np.array([0, 0, 120, 121, 300])
    found = decontamination.suffix_array(key, first)
    n = len(key) + 4
    rows = [tuple(found.key[i : i + 16].tolist()) for i in found.order]
    assert sorted(found.order.tolist()) == list(range(n))
    assert rows == sorted(rows)


def _passages():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 10, 14, 40])))) for i in range(12)]
    items += [(None, "nameless item words"), (3, "w1 w2 w3"), (99, None), (98, ""), ("97", "...")]
    items = [(None if i is None else int(i), t) for i, t in items]
    rows = []
    for d in range(60):
        w = rng.choices(vocabulary, k=rng.randrange(0, 80))
        if d % 3 == 0:
            own = (rng.choice(items)[1] or "").split()
            w[5:5] = own[rng.randrange(3) :]
        rows.append((d, rng.choice([" ", ", ", "\n"]).join(w).upper() if d % 2 else " ".join(w)))
    return rows, items


def test_contamination_equals_plain(spark):
    rows, items = _passages()
    rows = rows + ODD
    docs = plain.documents(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in decontamination.contamination(docs, bench).collect()]
    assert sorted(got, key=str) == sorted(plain.contamination(rows, items), key=str)
    clean = decontamination.decontaminate(docs, bench)
    assert clean.schema == docs.schema
    want = [r[0] for r in plain.contamination(rows, items) if not r[5]]
    assert sorted(r.doc_id or -1 for r in clean.collect()) == sorted(d or -1 for d in want)


def test_contamination_in_small_blocks_and_shards(spark, monkeypatch):
    rows, items = _passages()
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 50)
    docs = plain.documents(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = decontamination._blocks(spark, bench, 10)
    assert len(blocks) > 3
    found = decontamination.judge(pa.array([t for _, t in rows]), blocks)
    want = plain.contamination(rows, items)
    assert found["n_hit"] == [r[2] for r in want]
    assert found["items_sha256"] == [r[4] for r in want]
    assert docs.count() == len(rows)


def test_empty_benchmark_and_empty_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = plain.documents(spark, ODD)
    assert not any(r.contaminated for r in decontamination.contamination(docs, none).collect())
    assert decontamination.contamination(docs.limit(0), none).count() == 0
    assert decontamination.decontaminate(docs, none).count() == len(ODD)


def test_longest_matches(spark):
    rows = [(1, "a b c d e f"), (2, "x b c d e z"), (3, None)]
    items = [(7, "q b c d e f q"), (8, "nothing shared"), (9, "x b")]
    found = decontamination.longest_matches(
        plain.documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    )
    got = {r.item_id: (r.words, r.item_start, r.doc_id, r.doc_start) for r in found.collect()}
    assert got == {"7": (5, 1, 1, 1), "9": (2, 0, 2, 0)}


LICENSED = [
    (21, "Released under the MIT License. Under, the mit-license!"),
    (22, "the Apache License, Version 2.0 and CC BY-NC 4.0"),
    (23, "under the mit"),
    (24, "This work is licensed under the GNU General Public License, version 3."),
    (25, "Permission is hereby granted, free of charge, to any person obtaining a copy"),
    (26, "apache apache license version 2 license version 2"),
    (27, "cc by nc " * 3_000),
]


def test_licenses_equal_plain(spark):
    rows = LICENSED + ODD
    got = sorted((tuple(r) for r in licenses.scan_licenses(plain.documents(spark, rows)).collect()), key=str)
    want = []
    for doc_id, text in rows:
        w, starts, labels = plain.words(text, plain.ALNUM), [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            starts += at
            labels |= {label} if at else set()
        want.append((doc_id, len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))))
    assert [r[:6] for r in got] == sorted(want, key=str)
    by_id = {r[0]: r for r in got}
    assert by_id[24][6] == "gpl-3" and by_id[25][6] == "mit" and by_id[22][6] == "apache-2,cc-by-nc"
    assert all(0 <= r[7] <= 1 for r in got) and by_id[21][7] > 0.99
    assert licenses.scan_licenses(plain.documents(spark, [])).count() == 0


PRIVATE = [
    (31, "mail a.b+c@d-e.co.uk, x@y, @z.w, a@@b.c, q@r.s@t.u"),
    (32, "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0010.1.1.1 1.2.3"),
    (33, "4111 1111 1111 1111 and 4111-1111-1111-1112 and 9 4111111111111111"),
    (34, "+1 (980) 555-6268, +12, ++44 20 7946 0958 1234567, +1 555-0100-"),
    (35, "9" * 6_000 + "." + "1" * 5_000 + ".1.1"),
    (36, "é日本 a@b.c 🙂 1.1.1.1"),
]


def test_base_spans_equal_plain():
    rng = random.Random(5)
    alphabet = "0123456789 .-+()@ab"
    texts = [t for _, t in PRIVATE[:4] + PRIVATE[5:]]
    texts += ["".join(rng.choices(alphabet, k=60)) for _ in range(3_000)]
    texts += ["".join(rng.choices("0123456789 -", k=40)) for _ in range(1_000)]
    for t in texts:
        assert pii.base_spans(t) == plain.personal(t)
    assert pii.base_spans(PRIVATE[4][1]) == []


def test_pii_whole_run(spark):
    rng = random.Random(2)
    rows = list(PRIVATE) + ODD
    for d in range(100, 400):
        number = "".join(rng.choices("0123456789", k=10))
        phone = f"+1 ({number[:3]}) {number[3:6]}-{number[6:]}"
        mail = "".join(rng.choices("abcdefgh", k=6)) + "@mail.example.org"
        rows.append((d, f"words {rng.choice([phone, mail, '10.0.0.7'])} more words and 12 apples"))
    docs = plain.documents(spark, rows)
    tagger = pii.train(docs)
    got = {(r.doc_id, r.base_sha256): r for r in pii.find(docs, tagger).collect()}
    for doc_id, text in rows:
        base = plain.personal(text) if doc_id != 35 else []
        names = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        r = got[doc_id, hashlib.sha256(names.encode()).hexdigest()]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in base) for k in range(4)]
        assert set(filter(None, names.split(","))) <= set(r.spans.split(","))
    # the tagger alone finds most of what the rules find
    hits = found = 0
    for doc_id, text in rows:
        if doc_id and doc_id >= 350:
            base = plain.personal(text)
            hits += len(set(base) & set(pii.added_spans(text, [], tagger)))
            found += len(base)
    assert hits >= 0.6 * found
    masked = pii.redact(docs, tagger)
    assert masked.schema == docs.schema and masked.count() == len(rows)
    for r in masked.where("text IS NOT NULL").collect():
        assert not plain.personal(r.text) and r.n_chars == len(r.text)


def test_masking_joins_overlaps():
    assert pii.masked("ab 1.2.3.4 c", [(3, 1, 10)]) == "ab [IP] c"
    assert pii.masked("0123456789", [(2, 2, 6), (4, 3, 8)]) == "01[CARD]89"
    assert pii.masked("abc", []) == "abc"


def test_pii_without_any_personal_data(spark):
    docs = plain.documents(spark, ODD)
    assert pii.train(docs) is None
    assert pii.find(docs, None).count() == len(ODD)
    assert pii.find(docs.limit(0), None).count() == 0


def _library():
    """The library's own search over the same pieces with the same scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as model_format

    proto = model_format.ModelProto()
    with open(sentencepieces.MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        if p.type == 1:
            p.score = -float(np.log1p(max(-p.score, 0)))
    out = sentencepiece.SentencePieceProcessor()
    out.load_from_serialized_proto(proto.SerializeToString())
    return out


def test_pieces_score_as_the_library_and_decode_exactly(spark):
    pieces = sentencepieces.load()
    texts = [t or "" for _, t in ODD] + ["", " ", "  a  b ", "\n\nx", "🙂🙂 ▁", "Hello world, it's 1999."]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    ids, bounds = sentencepieces.encode(texts, pieces)
    assert sentencepieces.decode(ids, bounds, pieces) == texts
    library = _library()
    for i, text in enumerate(texts):
        if "▁" in text:
            continue  # the library takes it for a space
        own, other = ids[bounds[i] : bounds[i + 1]], library.encode(text)
        total = [sum(pieces.score[x] if np.isfinite(pieces.score[x]) else 0 for x in s) for s in (own, other)]
        assert total[0] == pytest.approx(total[1], rel=1e-4, abs=1e-3)


def test_pieces_of_documents(spark):
    docs = plain.documents(spark, ODD)
    rows = sentencepieces.add_pieces(docs, sentencepieces.load()).collect()
    assert len(rows) == len(ODD)
    assert rows[0].piece_ids == "b"  # a column of that name was there already
    for r in rows:
        if r.text is None:
            assert r.piece_ids_ is None and r.n_pieces is None and r.round_trip is None
        else:
            assert r.round_trip and r.n_pieces == len(r.piece_ids_)
    assert sentencepieces.add_pieces(docs.limit(0), sentencepieces.load()).count() == 0
