"""Archives, manifests and phrases: awkward tables and brute force."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from datetime import UTC, datetime

import numpy as np
import pyarrow as pa
import pytest

from eventloom.functions.storage import new_folder
from eventloom.llm import language, merkle, phrases, repeats, warc
from eventloom.llm.base import Generations

CLASH = ", ".join(f"{c} string" for c in ("digest", "key", "lo", "hi", "level", "word", "f", "n", "a", "batch", "name", "content"))
CLASHING = ("x",) * 12


# --- Archives -----------------------------------------------------------------------

PAGES = [
    (1, "http://a.example/", "<p>one</p>"),
    (2, "http://a.example/with blank\nand line", "<p>one</p>"),
    (3, None, None),
    (4, "", ""),
    (5, "http://b.example/é", "é" * 70_000),
    (5, "http://b.example/é", "é" * 70_000),
    (None, "http://c.example/", "<p>one</p>"),
    (None, "http://c.example/2", "only here"),
    (0, "http://d.example/", "HTTP/1.1 200 OK\r\n\r\n\r\nWARC/1.1\r\nX-Page-Id: 99\r\n\r\n"),
    (-7, "http://e.example/", "<p>one</p>"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*r, *CLASHING) for r in PAGES]
    return spark.createDataFrame(rows, f"page_id long, url string, html string, {CLASH}").repartition(3)


def archived(rows, least=0):
    groups = defaultdict(list)
    for page, _, html in rows:
        groups[(html or "").encode()].append(page)
    out = []
    for payload, members in groups.items():
        members = sorted(members, key=lambda p: (p is None, p or 0))
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for i, page in enumerate(members):
            revisit = i > 0 and len(payload) >= least
            out.append((page, len(payload), digest, "revisit" if revisit else "response", members[0] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 1, 20])
def test_pages_through_archives(pages, least):
    rows = warc.archive_pages(pages, least).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=str) == archived(PAGES, least)
    assert len({r.record_id for r in rows}) == len(rows)
    responses = {r.record_id: r for r in rows if r.record_type == "response"}
    for r in rows:
        if r.record_type == "revisit":
            assert responses[r.refers_to_id].payload_digest == r.payload_digest
            assert responses[r.refers_to_id].page_id == r.refers_to
    assert {r.target_uri for r in rows if r.page_id in (2, 3, 4)} == {"http://a.example/with%20blank%0Aand%20line", None}
    assert warc.archive_pages(pages.limit(0), least).collect() == []


def test_archives_of_both_versions(spark, pages):
    folder = new_folder(spark, "arc")
    warc.write_arcs(pages.repartition(4), folder)
    versions = set()
    for row in warc.read_files(spark, folder).collect():
        data = gzip.decompress(row.content)
        versions.add(int(data.split(b"\n")[1].split(b" ")[0]))
        assert list(warc.parse_arc(data))
    assert versions == {1, 2}


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_by_hand(version):
    date = datetime(2003, 4, 5, 6, 7, 8, tzinfo=UTC)
    blocks = [b"", b"\n\nline\n", "é\x00".encode(), b"9 9 9 9 9\n"]
    data = warc.arc_opening(version, "x") + b"".join(warc.arc_record(version, "x", "http://h/", date, b) for b in blocks)
    found = list(warc.parse_arc(data))
    assert [b for _, b in found] == blocks
    assert all(h["Archive-date"] == "20030405060708" and h["URL"] == "http://h/" for h, _ in found)
    assert set(found[0][0]) == set(warc.ARC_FIELDS[version])
    # A blank in a legacy URL belongs to it.
    old = data.replace(b"http://h/ ", b"http://h/a b ", 1)
    assert next(warc.parse_arc(old))[0]["URL"] == "http://h/a b"
    with pytest.raises(ValueError):
        list(warc.parse_arc(data[:-3]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(data.replace(f"{version} 0 ".encode(), b"3 0 ", 1)))


def test_altered_archives_are_told():
    record = warc.warc_record({"WARC-Type": "response", "WARC-Record-ID": "<x>", "X-Payload-Length": 3, "WARC-Payload-Digest": "sha1:A"}, b"H\r\n\r\nabc")
    ((head, block),) = warc.parse_warc(record)
    assert block == b"H\r\n\r\nabc"
    with pytest.raises(ValueError):
        warc._checked(head, b"H\r\n\r\nabd")
    with pytest.raises(ValueError):
        warc._checked(head, block)  # another payload digest
    with pytest.raises(ValueError):
        list(warc.parse_warc(record[:-1]))


# --- Manifest -----------------------------------------------------------------------


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def steps_of(levels, at):
    for level in levels[:-1]:
        run = at // 3 * 3
        yield level[run:at], level[at + 1 : run + 3]
        at //= 3


def manifest_of(rows):
    """``rows`` are (doc_id, source, lang, n_chars, text)."""
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    trees = {}
    for source, members in sources.items():
        members.sort(key=lambda m: m[:3])
        trees[source] = levels_of([m[2] for m in members])
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    crown = levels_of([trees[s][-1][0] for s in names])
    out = []
    for at_source, source in enumerate(names):
        for at, (_, _, leaf, row) in enumerate(sources[source]):
            steps = [*steps_of(trees[source], at), *steps_of(crown, at_source)]
            proof = h("".join("".join(left + right) for left, right in steps))
            tampered = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                tampered = (*row[:4], row[4].replace("\n", ""))
            digest = leaf_of(tampered)
            for left, right in steps:
                digest = h("".join([*left, digest, *right]))
            out.append((row[0], leaf, trees[source][-1][0], crown[-1][0], proof, digest, digest == crown[-1][0]))
    return sorted(out, key=str)


def manifest_rows(spark, rows):
    docs = spark.createDataFrame(
        [(*r, *CLASHING) for r in rows], f"doc_id long, source string, lang string, n_chars long, text string, {CLASH}"
    )
    return sorted((tuple(r) for r in merkle.manifest(docs.repartition(3)).collect()), key=str)


def test_manifest_of_awkward_rows(spark):
    rows = [(i, "big", "en", i, f"text {i}\nof\n{'é' * (i % 5)}") for i in range(250)]
    rows += [(i, f"s{i % 7}é", None, None, "\n") for i in range(40)]
    rows += [(7, None, "de", 3, "a\nb"), (7, None, "de", 3, "a\nb"), (None, None, None, None, None), (None, "big", "", 0, "\n"), (-1, "", "x", 1, "")]
    rows += [(300, "alone", "fr", 1 << 40, "x\n" * 100_000), (301, "2", "fr", 0, None), (302, "2", "fr", 0, "b\n")]
    assert manifest_rows(spark, rows) == manifest_of(rows)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 81, 82])
def test_manifest_of_one_source(spark, size):
    rows = [(i, "s", "en", i, f"text\n{i}") for i in range(size)]
    assert manifest_rows(spark, rows) == manifest_of(rows)


def test_manifest_of_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.manifest(docs).collect() == []


# --- Phrases ------------------------------------------------------------------------


def phrases_of(rows, least, longest=5, top=2000):
    count, size = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            size[lang] += len(words)
            for k in range(1, longest + 1):
                count[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in count.items():
        found = [p for p, a in f.items() if len(p) > 1 and a >= least]
        best = []
        for p in found:
            a = f[p]
            if any(len(q) > len(p) and f[q] >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q in found):
                continue
            cuts = [(1000 * a * size[lang] // (f[p[:j]] * f[p[j:]]), j, f[p[:j]], f[p[j:]]) for j in range(1, len(p))]
            score, _, left, right = min(cuts)
            best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, size[lang], -score))
    return sorted(out)


def texts(seed, size):
    r = random.Random(seed)
    words = ["the", "The", "of", "ha", "é", "ÉÉ", "a\x1cb", "x y", "　", "new", "york", "times", "42", "-", "'s"]
    for _ in range(size):
        parts = [r.choice([r.choice(words), "New York", "new york times", "of the", "ha ha"]) for _ in range(r.randint(0, 40))]
        yield r.choice(["en", "de", None, "und"]), "".join(p + r.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", " "]) for p in parts)


@pytest.mark.parametrize(("least", "longest", "top"), [(3, 5, 2000), (12, 5, 7), (6, 3, 2000)])
def test_phrases_by_brute_force(spark, least, longest, top):
    rows = [*texts(least, 150), (None, None), ("en", ""), ("fr", "one two"), ("en", "new york times " * 30_000)]
    docs = spark.createDataFrame([(*r, *CLASHING) for r in rows], f"lang string, text string, {CLASH}").repartition(4)
    got = sorted(tuple(r) for r in phrases.collocations(docs, least, longest, top).collect())
    assert got == phrases_of(rows, least, longest, top) and got


def test_phrases_of_nothing(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(docs).collect() == []
    docs = spark.createDataFrame([("en", "too few words")], "lang string, text string")
    assert phrases.collocations(docs).collect() == []


def test_tiles_count_what_coordinates_count():
    r = np.random.default_rng(5)
    ids = np.concatenate([[0], r.permutation(np.r_[1:6000, 1 << 33, (1 << 33) + 1])]).astype(np.int64)
    by_id = {int(i): p for p, i in enumerate(ids)}
    # Enough pairs of frequent ids for dense tiles, some rare ones, and ids beyond 32 bits.
    a = np.concatenate([r.integers(1, 40, 200_000), r.integers(1, 2000, 100_000), r.integers(1, 6000, 5000), [1 << 33, 7]])
    b = np.concatenate([r.integers(1, 40, 200_000), r.integers(1020, 1030, 100_000), r.integers(1, 6000, 5000), [(1 << 33) + 1, 1 << 33]])
    left, right = (np.array([by_id[int(i)] for i in x], np.int32) for x in (a, b))
    place, firsts, seconds, counts = phrases.count_pairs(ids, left, right)
    wanted = Counter(zip(a.tolist(), b.tolist(), strict=True))
    assert dict(zip(zip(firsts.tolist(), seconds.tolist(), strict=True), counts.tolist(), strict=True)) == wanted
    assert (firsts[place - 1] == a).all() and (seconds[place - 1] == b).all()


def parts_of(batches, parts):
    """The rows that batches of pairs send, by part."""
    out = defaultdict(list)
    for batch, (a, b, counts) in batches.items():
        _, cut = phrases.parted(np.array(a), np.array(b), np.array(counts), parts)
        for row in cut[0].as_py():
            out[row["part"]].append({"lang": "en", "batch": batch, **row})
    return out


def test_a_batch_sends_a_row_a_part_and_a_few_bytes_a_pair():
    r = np.random.default_rng(8)
    code = np.unique(r.zipf(1.3, 400_000) % 20_000 * 20_000 + r.zipf(1.3, 400_000) % 20_000)
    batches = {7: (code // 20_000 + 1, code % 20_000 + 1, np.ones(len(code), int))}
    rows = [x for found in parts_of(batches, 64).values() for x in found]
    assert len(rows) == 64
    assert sum(len(x["keys"]) + len(x["counts"]) for x in rows) < 4 * len(code)


def test_parts_of_pairs_add_up():
    wide = 1 << 33
    batches = {
        1: ([5, 5, 9, wide], [1, 2, 9, wide + 1], [2, 3, 1, 4]),
        2: ([9, wide, 5], [9, wide + 1, 1], [8, 1, 4]),
        3: ([wide], [wide], [1]),
    }
    for parts in (1, 3):
        found, told, f = {}, {}, Counter()
        for a, b, counts in batches.values():
            for x, y, n in zip(a, b, counts, strict=True):
                f[x, y] += n
        for part, rows in parts_of(batches, parts).items():
            for row in phrases.add_pairs(pa.Table.from_pylist(rows), parts, 5).to_pylist():
                if row["batch"] is None:
                    found |= {(x, y): (n, i) for x, y, n, i in zip(row["a"], row["b"], row["f"], row["id"], strict=True)}
                    assert row["f"] == sorted(row["f"], reverse=True) and {(i - 1) % parts for i in row["id"]} <= {part}
                else:
                    places = np.cumsum(phrases._unsqueeze(row["places"]))
                    told.setdefault(row["batch"], {}).update(zip(places, phrases._unsqueeze(row["ids"], np.int64), strict=True))
        assert {k: n for k, (n, _) in found.items()} == {k: n for k, n in f.items() if n >= 5}
        assert len({i for _, i in found.values()}) == len(found)
        for batch, (a, b, counts) in batches.items():
            anew, _ = phrases.parted(np.array(a), np.array(b), np.array(counts), parts)
            wanted = {anew[i + 1]: found[k][1] for i, k in enumerate(zip(a, b, strict=True)) if k in found}
            assert told.get(batch, {}) == wanted


# --- Bounds -------------------------------------------------------------------------


def test_generations_forget_the_rare_ones_only():
    asked = []
    memory = Generations(lambda k: asked.append(k) or k * 2, 100)
    for i in range(5000):
        assert memory[i % 20] == (i % 20) * 2
        assert memory[1000 + i] == 2000 + 2 * i
        assert len(memory) + len(memory.older) <= 101
    assert asked.count(3) == 1 and len(asked) == 5020


def test_language_sample_is_bounded(spark):
    r = random.Random(1)
    one, two, three = [i for i in range(99) if zlib.crc32(str(i).encode()) % 4 != language.HELD_OUT][:3]
    many = [(one, f"wort{i} nummer", "de") for i in range(2000)]
    long = " ".join("".join(r.choice("abcdefgh") for _ in range(8)) for _ in range(400_000))
    docs = spark.createDataFrame([*many, (two, long, "en"), (three, long, "en")], "doc_id long, text string, lang string")
    learnt = language.learn(docs.repartition(8))
    assert set(learnt) == {"de", "en"}
    assert len(learnt["de"].split()) == 2  # one text of the repeated id
    assert all(len(t) <= language.TRAIN_CHARS for t in learnt.values())


# --- Passages -----------------------------------------------------------------------


def test_stage_cuts_passages_of_over_fifty_words(spark):
    r = random.Random(11)
    made = iter(range(10**9))

    def fresh(n):
        """Words that no other text has."""
        return " ".join(f"{r.choice('abcdefgh')}{next(made):x}" for _ in range(n))

    long, short, wide = fresh(51), fresh(40), "".join(r.choice("abc") for _ in range(420))
    long = " ".join(w + "xy"[: max(0, 5 - len(w))] for w in long.split())
    short = " ".join(w + "xyzx" for w in short.split())
    assert repeats.PASSAGE_BYTES <= len(long) < repeats.LENGTH and repeats.PASSAGE_BYTES <= len(short) < repeats.LENGTH
    # What stands beside a passage differs from its first byte on.
    passages = (long, long, long, short, short, wide, wide)
    parts = [(f"{fresh(80)} {i}", passage, f"{i} {fresh(70)}") for i, passage in enumerate(passages)]
    clean = [fresh(200) for _ in range(20)]
    texts = [" ".join(p) for p in parts] + clean
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    out = {x.doc_id: x.text for x in repeats.repeats_stage(spark, docs, "").collect()}
    for i, (before, passage, after) in enumerate(parts):
        gone = passage != short
        # Blanks on both sides of a passage belong to it where all copies have them.
        assert out[i].replace(" ", "") == f"{before}{'' if gone else passage}{after}".replace(" ", "")
    assert [out[len(parts) + i] for i in range(20)] == clean
