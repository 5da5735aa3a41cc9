"""Awkward tables through every operator: each has a defined result and none crashes."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from eventloom.llm import (
    bpe,
    fingerprints,
    jaccard,
    language,
    packing,
    quality,
    repeats,
    scoring,
    sharding,
    urls,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kept string, score string, words string, row string, rest string, batch string, key string, place string, part string"
)
CLASH = ("x",) * 9


def _long_text(words: int) -> str:
    r = random.Random(3)
    vowels, others = "aeiou", "bcdfghklmnprst"
    names = ["".join(r.choice(others) + r.choice(vowels) for _ in range(r.randint(1, 4))) for _ in range(900)]
    return " ".join(r.choice(names) for _ in range(words))


PLAIN = "The cat of the house is in the garden and it was there with the dog for a long day. " * 2
ROWS = [
    (1, PLAIN + "one", "en", "s", 9),
    (2, None, None, None, None),
    (3, "", "en", "s", 0),
    (4, " \t\n ", "en", "s", 4),
    (5, _long_text(30_000), "en", "s", 1),
    (6, PLAIN + "one", "en", "s", 9),
    (6, PLAIN + "one", "en", "s", 9),
    (None, "Der Hund ist nicht im Garten und die Katze auch nicht. " * 9, "de", None, 5),
    (None, None, "de", None, None),
    (9, "12 34 !!", "fr", "s", 2),
    (10, "a\x1cb é́ 日本 ΑΣ <|endoftext|>x it's I'LL 99 \x00 İ", "fr", "s", 2),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *CLASH) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (5, 0, 0), (None, 1, 0), (6, 1, None), (6, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def ids(rows):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)


ALL_IDS = sorted((r[0] is None, r[0] or 0) for r in ROWS)


def texts():
    return [r[1] or "" for r in ROWS]


def test_packing(docs, none):
    rows = packing.pack_documents(docs).collect()
    encode = packing.tokenizer(packing.VOCABULARY).encode
    wanted = []
    for doc, text, *_ in ROWS:
        found = encode(text or "", add_special_tokens=False).ids + [1]
        for i, at in enumerate(range(0, len(found), 4096)):
            part = found[at : at + 4096]
            wanted.append((doc or 0, i, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = [(r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got) == sorted(wanted)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(bins) == -(-sum(r.length for r in rows) // 4096)
    assert packing.pack_documents(none).collect() == []


def test_sharding(docs, none):
    rows = sharding.shard_documents(docs).collect()
    sizes = sorted(len(t.encode()) + 8 for t in texts())
    assert ids(rows) == ALL_IDS and sorted(r.size for r in rows) == sizes
    assert sorted(r.text_crc32 for r in rows) == sorted(zlib.crc32(t.encode()) for t in texts())
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert len({r.shard for r in rows if r.doc_id == 6}) == 1
    assert sharding.shard_documents(none).collect() == []


def test_quality(docs, none, labels):
    rows = quality.judge(docs, labels).select("row.doc_id", "n_words", "base_failed", "kept").collect()
    assert ids(rows) == ALL_IDS
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert quality.judge(none, labels).collect() == []
    assert quality.judge(docs, labels.limit(0)).count() == len(ROWS)


def test_quality_stage_keeps_columns(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = quality.quality_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} <= {r[0] for r in ROWS}
    assert quality.quality_stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_scores(docs, none):
    rows = scoring.score_documents(docs).collect()
    assert ids(rows) == ALL_IDS
    for r in rows:
        assert (r.mean_log_score is None) == (r.n_words == 0)
        assert r.log_score <= 0
    assert scoring.score_documents(none).collect() == []


def test_bpe(docs, none):
    rows = bpe.digest_documents(docs).collect()
    exact = packing.tokenizer(bpe.VOCABULARY)
    wanted = []
    for doc, text, *_ in ROWS:
        found = exact.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest()
        decoded = hashlib.sha256(exact.decode(found, skip_special_tokens=False).encode()).hexdigest()
        wanted.append((doc or 0, len(found), digest, decoded))
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(wanted)
    assert bpe.digest_documents(none).collect() == []


def test_repeats(docs, none):
    rows = repeats.digest_repeats(docs).collect()
    assert ids(rows) == ALL_IDS
    assert sorted(r.n_bytes for r in rows) == sorted(len(t.encode()) for t in texts())
    assert repeats.digest_repeats(none).collect() == []


def test_repeats_stage_keeps_columns(spark, docs):
    out = repeats.repeats_stage(spark, docs, "")
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = out.collect()
    assert ids(rows) == ALL_IDS
    # The German text repeats itself; its hole leaves whole characters. Null texts stay null.
    assert sum(r.text is None for r in rows) == 2
    assert all(r.text is None or r.n_chars == len(r.text) for r in rows)
    assert {r.score for r in rows} == {"x"}


def test_fingerprints(docs, none):
    rows = fingerprints.fingerprint_documents(docs).collect()
    assert ids(rows) == ALL_IDS
    # Null ids first, then by id; rows of equal ids by text.
    order = sorted(((r[0] is not None, r[0] or 0, r[1] or "") for r in ROWS))
    wanted = []
    for i, (known, doc, text) in enumerate(order):
        after, half = order[(i + 1) % len(order)][2], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        wanted.append((doc, known, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    got = [(r.doc_id or 0, r.doc_id is not None, r.n_chars, r.edited_sha256) for r in rows]
    assert sorted(got) == sorted(wanted)
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    same = {r.fingerprint for r in rows if r.doc_id in (1, 6)}
    assert len(same) == 1
    assert fingerprints.fingerprint_documents(none).collect() == []


def test_language(docs, none):
    rows = language.predict_documents(docs).collect()
    assert ids(rows) == ALL_IDS
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (2, 3, 4, 9))
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 4 == 2)
        assert 0 <= r.score <= 1
    assert language.predict_documents(none).collect() == []
    assert {r.lang_pred for r in language.predict_documents(docs, {}).collect()} == {"und"}


def test_language_stage_keeps_columns(spark, docs):
    out = language.language_stage(spark, docs, "")
    assert out.columns == docs.columns
    assert not {2, 3, 4, 9} & {r.doc_id for r in out.collect()}


def test_jaccard(docs, none):
    rows = jaccard.join_documents(docs).collect()
    assert ids(rows) == ALL_IDS
    classes = {r.doc_id: r.class_id for r in rows if r.doc_id is not None}
    assert classes[1] == classes[6] == 1 and classes[2] == classes[3] == classes[4] == 2
    assert classes[5] == 5 and classes[9] == 9
    assert jaccard.join_documents(none).collect() == []


def test_jaccard_stage_keeps_one_of_a_class(spark, docs):
    out = jaccard.jaccard_stage(spark, docs, "")
    assert out.columns == docs.columns
    left = [r.doc_id for r in out.collect()]
    assert sorted(x for x in left if x is not None) == [1, 2, 5, 9, 10] and left.count(None) == 1


def test_urls(spark):
    entries = spark.createDataFrame(
        [
            ("bad.org", "2023-01-10", 1),
            ("bad.org", "2023-01-20", 0),
            ("bad.org", "2023-01-20", 1),  # of one day the listing wins: no gap
            ("bad.org", "2023-02-01", 0),
            ("bad.org", "2023-03-01", 0),  # off already
            ("a.bad.org/ads", "2023-01-01", 1),
            ("off.org", "2023-01-01", 0),
            (None, "2023-01-01", 1),
            ("null.org", None, 1),
        ],
        "pattern string, listed_on string, listed int",
    ).selectExpr("pattern", "CAST(listed_on AS date) AS listed_on", "listed", "1 AS host")
    captures = spark.createDataFrame(
        [
            (1, "http://bad.org/x", "2023-01-09"),
            (2, "http://bad.org/x", "2023-01-10"),
            (3, "https://u:p@B.Bad.org.:8080?q", "2023-01-25"),
            (4, "http://bad.org/x", "2023-02-01"),
            (5, "http://a.bad.org/ads/1", "2023-01-15"),
            (6, "http://a.bad.org/ads/1", "2023-05-15"),
            (7, "http://notbad.org/", "2023-01-15"),
            (8, None, "2023-01-15"),
            (9, "http://bad.org", None),
            (9, "no url", "2023-01-15"),
            (None, "http://off.org", "2023-01-15"),
        ],
        "page_id long, url string, fetched_on string",
    ).selectExpr("*", "1 AS pattern", "2 AS section")
    rows = urls.judge_captures(captures, entries).collect()
    assert len(rows) == 11
    hits = {r.page_id: (r.pattern, str(r.valid_from)) for r in rows if r.blocked}
    assert hits == {
        2: ("bad.org", "2023-01-10"),
        3: ("bad.org", "2023-01-10"),
        5: ("a.bad.org/ads", "2023-01-01"),
        6: ("a.bad.org/ads", "2023-01-01"),
    }
    assert urls.judge_captures(captures, entries.limit(0)).filter("blocked").collect() == []
    assert urls.judge_captures(captures.limit(0), entries).collect() == []
