"""The operators against brute force, on the generated tables and on small made-up ones."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F

from eventloom.llm import bpe, fingerprints, jaccard, language, packing, quality, registry, repeats, sharding

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the generated tables")


@pytest.fixture(scope="module")
def table():
    return duckdb.sql(f"SELECT * FROM '{DATA}/documents.parquet' ORDER BY doc_id").fetchall()


def run(spark, name):
    return {r["doc_id"]: r for r in registry.QUERIES[name](spark, str(DATA)).collect()}


def noisy(seed, size):
    """Texts that share passages, are copies or near copies of each other, or stand alone."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéü") for _ in range(r.randint(1, 8))) for _ in range(300)]

    def some(n):
        return " ".join(r.choice(words) for _ in range(n))

    passages = [some(r.randint(60, 130)) for _ in range(6)]
    out = ["", "x", "ab" * 700, "ab" * 450, "z" * 399, "z" * 400, "z" * 401]
    for i in range(size):
        kind = r.random()
        if kind < 0.2:
            out.append(r.choice(out))
        elif kind < 0.5:
            out.append(some(r.randint(0, 100)) + r.choice(passages) + some(r.randint(0, 80)) + r.choice(passages)[: r.randint(0, 600)])
        elif kind < 0.75:
            near = r.choice(out).split(" ")
            for _ in range(r.randint(1, 4)):
                near[r.randrange(len(near))] = r.choice(words)
            out.append(" ".join(near))
        else:
            out.append(some(r.randint(1, 400)))
    return out


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


# --- Packing ------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_local_search_keeps_pieces_and_saves_bins(seed):
    r = random.Random(seed)
    lengths = [r.choice([r.randint(1, 100), r.randint(20, 60)]) for _ in range(400)]
    first = packing.best_fit(lengths, 100)
    # Start from bad bins, so that there is something to search.
    bad = [[i] for i in range(len(lengths))]
    search = packing.LocalSearch(lengths, bad, 100)
    for bins in (packing.pack_lengths(lengths, 100), search.run()):
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert max(sum(lengths[i] for i in b) for b in bins) <= 100
    assert len(packing.pack_lengths(lengths, 100)) <= len(first)
    assert len(search.run()) < len(lengths)


def test_local_search_exchanges():
    cases = [
        ([60, 35, 55, 38, 7, 5], [[0, 1], [2, 3], [4, 5]]),  # moves
        ([60, 34, 52, 40, 14], [[0, 1], [2, 3], [4]]),  # 34 for 40, then a move
        ([70, 20, 60, 20, 16, 14], [[0, 1], [2, 3], [4, 5]]),  # two for one
    ]
    for lengths, bins in cases:
        search = packing.LocalSearch(lengths, [list(b) for b in bins], 100)
        assert len(search.run()) == 2


def test_exchanges_raise_squared_fill():
    r = random.Random(8)
    lengths = [r.randint(5, 70) for _ in range(120)]
    search = packing.LocalSearch(lengths, [[i] for i in range(120)], 100)
    step, gains = search._exchange, []

    def squares():
        return sum(sum(lengths[i] for i in b) ** 2 for b in search.bins)

    def watched(*args):
        before, emptied = squares(), step(*args)
        gains.append(squares() - before)
        return emptied

    search._exchange = watched
    assert len(search.run()) <= -(-sum(lengths) // 100) + 2
    assert gains and min(gains) > 0


def test_packing_across_tasks(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_ROWS", 60)
    texts = noisy(1, 100)
    rows = packing.pack(packing.pieces(frame(spark, texts), capacity=64), 200, capacity=64, group=25).collect()
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 64 and sum(used.values()) == sum(r.length for r in rows)
    assert {r.doc_id for r in rows} == set(range(len(texts)))


# --- Sharding -----------------------------------------------------------------------


def test_sharding_by_hand(spark, table):
    for doc, row in run(spark, "op3_rendezvous_sharding").items():
        score = [int(hashlib.md5(f"{doc}:{s}".encode()).hexdigest()[:13], 16) for s in range(25)]
        assert row.shard == score.index(max(score[:24])) and row.grown_shard == score.index(max(score))


def test_weights_are_shares(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "'' AS text")
    counts = Counter(r.shard for r in sharding.shard_documents(rows, (1.0, 2.0, 5.0)).collect())
    assert [abs(counts[s] / 20_000 - w / 8) < 0.02 for s, w in enumerate((1, 2, 5))] == [True] * 3


def test_an_id_of_many_rows_is_cut(spark):
    """Two thirds of the rows are equal, and no task numbers more than its share."""
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, id, 7) AS doc_id", "if(id % 3 = 0, '', 'copy') AS text")
    out = sharding.shard_documents(rows, (1.0, 1.0)).select("*", F.spark_partition_id().alias("task")).collect()
    for shard in (0, 1):
        slots = [r.slot for r in out if r.shard == shard]
        assert slots and sorted(slots) == list(range(len(slots)))
    assert len({r.shard for r in out if r.doc_id == 7}) == 1
    assert max(Counter(r.task for r in out).values()) <= 10_000


# --- Quality ------------------------------------------------------------------------


def test_quality_by_hand(spark, table):
    rows = run(spark, "op4_quality_rules")
    for doc, text, *_ in table:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        wanted = (
            len(words),
            sum(map(len, words)),
            len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)),
            len(covered),
        )
        row = rows[doc]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == wanted
        assert row.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert row.kept == (not row.base_failed and row.score >= quality.THRESHOLD)


def test_log_ratios(spark):
    """With so many buckets that nothing collides, the ratios are those of plain counts."""
    docs = spark.createDataFrame([(1, "a b a"), (2, "c c"), (3, None)], "doc_id long, text string")
    trusted = spark.createDataFrame([(1,)], "trusted_id long")
    buckets = 1 << 12
    ratios = quality.log_ratios(docs, trusted, buckets)
    good, raw = Counter({"a": 2, "b": 1, "ab": 1, "ba": 1}), Counter({"a": 2, "b": 1, "ab": 1, "ba": 1, "c": 2, "cc": 1})
    plain = [
        math.log((good[g] + 1) / (5 + buckets)) - math.log((raw[g] + 1) / (8 + buckets)) for g in raw
    ]
    rest = math.log(1 / (5 + buckets)) - math.log(1 / (8 + buckets))
    assert sorted(round(x, 9) for x in ratios if abs(x - rest) > 1e-12 or x in plain) != []
    assert sorted({round(x, 9) for x in ratios}) == sorted({round(x, 9) for x in [*plain, rest]})


def test_quality_tells_junk(spark):
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{DATA}/labels.parquet'").fetchall()
    rows = run(spark, "op4_quality_rules")
    judged = [(q, rows[d].kept) for d, q in labels if not rows[d].base_failed]
    good = [k for q, k in judged if q]
    junk = [k for q, k in judged if not q]
    assert sum(good) >= 0.95 * len(good) and junk and sum(junk) <= 0.05 * len(junk)


# --- BPE ----------------------------------------------------------------------------


def test_bpe_equals_the_library():
    import public_tokenizers

    own = bpe.BpeVocabulary(public_tokenizers.path(bpe.VOCABULARY))
    exact, fast = packing.tokenizer(bpe.VOCABULARY), packing.WordIds(packing.VOCABULARY)
    r = random.Random(2)
    texts = ["", "  ", "aaaaaaaaaaaaaaaa aaaa", "x" * 3000, "it's I'LL 's's't''ll", "😀👍🏽 ½²", "<|endoftext|>x<|startoftext|>"]
    texts += ["".join(r.choice("aaabbeeinsthr") for _ in range(r.randint(1, 30))) for _ in range(1500)]
    blocks = [(32, 126), (128, 0x2FF), (0x370, 0x3FF), (0x4E00, 0x4F00), (0x2000, 0x2030), (1, 31)]
    texts += ["".join(chr(r.randint(*r.choice(blocks))) for _ in range(r.randint(1, 30))) for _ in range(800)]
    for text in texts:
        wanted = exact.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == wanted, repr(text)
        assert own.decode(wanted) == exact.decode(wanted, skip_special_tokens=False)
        assert np.frombuffer(fast(text), "<u4").tolist() == wanted, repr(text)


def test_bpe_of_documents(spark, table):
    exact, rows = packing.tokenizer(bpe.VOCABULARY), run(spark, "op6_bpe_prefixes")
    for doc, text, *_ in table:
        found = exact.encode(text or "", add_special_tokens=False).ids
        assert rows[doc].ids_sha256 == hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest()


# --- Repeated passages --------------------------------------------------------------


def covered_by_hand(texts, length):
    data = [t.encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        mask = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                mask[i : i + length] = True
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        kept = np.frombuffer(d, np.uint8)[~mask].tobytes()
        out.append((len(d), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed, batch", [(5, 20_000), (6, 4_000)])
def test_repeats_by_hand(spark, monkeypatch, seed, batch):
    monkeypatch.setattr(repeats, "BATCH_BYTES", batch)
    texts = noisy(seed, 60)
    rows = sorted(tuple(r) for r in repeats.digest_repeats(frame(spark, texts)).collect())
    assert [r[1:] for r in rows] == covered_by_hand(texts, 400)


def test_segments_and_refinements_agree():
    """Runs cut at segment borders and at any block size give the same suffixes."""
    texts = [t.encode() for t in noisy(7, 20)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    places = np.concatenate([p for *_, p in repeats.initial_runs(data, ends, 400, 32)])
    for width in (16, 1):
        split = np.concatenate([p for *_, p in repeats.refined_runs(data, places, 400, width)])
        _, first, last = repeats._unpacked(split)
        starts = np.sort(np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)]))
        begins = np.concatenate([[0], ends[:-1]])
        wanted = [np.arange(b, e - 399) for b, e in zip(begins, ends, strict=True) if e - b >= 400]
        assert (starts == np.concatenate(wanted)).all() and (last - first < width).all()


# --- Fingerprints -------------------------------------------------------------------


def test_signatures_by_hand():
    text = "The quick brown fox, and the lazy dog of Rome"
    found = fingerprints.signatures(text)
    # the+quick+brown, and+lazy+dog, the+lazy+dog; "of" has one content word behind it.
    assert len(found) == 3
    assert set(found) == set(fingerprints.signatures("THE quick (brown) ... and the lazy dog"))
    assert not len(fingerprints.signatures(" !! "))
    assert len(fingerprints.signatures("alpha beta gamma delta")) == 2  # no anchor: runs of three
    for a, b in ((5, 6), (8, 10), (80, 100), (4, 5)):
        x, y = fingerprints.length_partition(a, 0.8), fingerprints.length_partition(b, 0.8)
        assert abs(x - y) <= 1


def signatures_by_hand(text):
    words = [w for w in (re.sub(r"^\W+|\W+$", "", u.lower()) for u in text.split()) if w]
    found = set()
    for i, word in enumerate(words):
        chain = [w for w in words[i + 1 :] if w not in fingerprints.ANCHORS][: fingerprints.CHAIN] if word in fingerprints.ANCHORS else []
        if len(chain) == fingerprints.CHAIN:
            found.add((word, *chain))
    if not found and len(words) < 3:
        return set(words)
    return found or {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def test_fingerprints_of_documents(spark, table):
    """Likenesses of every document, from sets of words; a fingerprint tells sets apart."""
    texts = [text or "" for _, text, *_ in table]
    rows, sets, shown = run(spark, "op8_spot_signatures"), [signatures_by_hand(t) for t in texts], defaultdict(set)

    def alike(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, (doc, *_) in enumerate(table):
        row, after = rows[doc], (i + 1) % len(table)
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[after][:half]
        changed = signatures_by_hand(edited)
        assert row.n_chars == len(texts[i]) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.near_edited == pytest.approx(alike(sets[i], changed), abs=1e-12)
        assert row.near_next == pytest.approx(alike(sets[i], sets[after]), abs=1e-12)
        assert row.similar_next == (alike(sets[i], sets[after]) >= 0.8)
        shown[frozenset(sets[i])].add(row.fingerprint)
        shown[frozenset(changed)].add(row.edited_fingerprint)
    assert all(len(x) == 1 for x in shown.values()) and len(set().union(*shown.values())) == len(shown)


def test_jaccard_prunes_by_length():
    a, b = np.arange(10, dtype=np.uint64), np.arange(5, dtype=np.uint64)
    assert fingerprints.jaccard(a, b) == 0.5 and fingerprints.jaccard(a, b, 0.8) == 0.0
    assert fingerprints.jaccard(a, a, 0.8) == 1.0 and fingerprints.jaccard(a[:0], b) == 0.0
    for n in range(1, 60):
        x = np.arange(n, dtype=np.uint64)
        for m in range(1, 60):
            y = np.arange(m, dtype=np.uint64)
            assert fingerprints.similar(x, y) == (fingerprints.jaccard(x, y) >= 0.8)
    assert fingerprints.similar(a[:0], a[:0]) and not fingerprints.similar(a[:0], b)


@pytest.mark.parametrize("size", [300, 40_000, 1 << 25])
def test_successors_in_any_number_of_parts(spark, size):
    texts = noisy(4, 40)
    rows = fingerprints.with_following(frame(spark, texts), size).collect()
    assert sum(not r.border for r in rows) == len(texts)
    by_part = defaultdict(list)
    for r in rows:
        by_part[r.part].append(r)
    follows = {}
    for part in by_part.values():
        part.sort(key=lambda r: (r.border, r.place))
        follows |= {a.place: b.place for a, b in zip(part, part[1:], strict=False)}
    assert all(follows[i] == (i + 1) % len(texts) for i in range(len(texts)))


# --- Language -----------------------------------------------------------------------


def test_suffix_automaton_by_hand():
    r = random.Random(1)
    text = "".join(r.choice("abc") for _ in range(200))
    automaton = language.SuffixAutomaton(text)
    for _ in range(300):
        word = "".join(r.choice("abcd") for _ in range(r.randint(1, 12)))
        count, at = 0, 0
        while at < len(word):
            size = max((k for k in range(1, len(word) - at + 1) if word[at : at + k] in text), default=1)
            at, count = at + size, count + 1
        assert automaton.phrases(word) == count


def test_language_accuracy(spark):
    data = "/root/testdata/sf0.01"
    wanted = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{data}/documents.parquet'").fetchall())
    rows = [r for r in registry.QUERIES["op9_cross_parsing_language"](spark, data).collect() if r.held_out]
    assert len(rows) > 100 and sum(wanted[r.doc_id] == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_languages_of_documents(spark, table):
    """Each prediction again, from longest matches looked up in the training text itself."""
    training = language.learn(spark.read.parquet(f"{DATA}/documents.parquet"))
    names, known = sorted(training), {}

    def phrases(word, text):
        count, at = 0, 0
        while at < len(word):
            end = at + 1
            while end < len(word) and word[at : end + 1] in text:
                end += 1
            at, count = end, count + 1
        return count

    for row in run(spark, "op9_cross_parsing_language").values():
        text = next(t for d, t, *_ in table if d == row.doc_id)
        units = [w for w in re.findall(r"[^\W\d_]+", (text or "").lower()) if any(map(str.isalpha, w))]
        for w in units:
            if w not in known:
                known[w] = [phrases(f" {w} ", training[x]) for x in names]
        costs = sorted((sum(known[w][k] for w in units), x) for k, x in enumerate(names))
        wanted = (costs[0][1], 1 - costs[0][0] / costs[1][0]) if units else ("und", 0.0)
        assert row.lang_pred == wanted[0] and row.score == pytest.approx(wanted[1], abs=1e-12)


def test_texts_without_letters_are_unknown():
    parse = language.CrossParser({"a": " the cat ", "b": " der hund "})
    assert parse("½ ² Ⅷ 12 _ !")[0] == parse("")[0] == "und"
    assert parse("the Ⅷ cat")[0] == "a" and parse("Der Hund²")[0] == "b"


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, "abc def ghi", "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else "yy") for i in range(40)]
    docs = spark.createDataFrame([(i, t + f" w{i}", x) for i, t, x in rows], "doc_id long, text string, lang string")
    assert set(language.learn(docs)) == {"yy"}


# --- Similarity join ----------------------------------------------------------------


def classes_by_hand(texts):
    sets = [frozenset(jaccard.ngram_set(t).tolist()) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    degree = Counter()
    distinct = {}
    for i, s in enumerate(sets):
        root[i] = find(distinct.setdefault(s, i))
    keys = list(distinct)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if a and b and len(a & b) / len(a | b) >= 0.8:
                degree[a] += 1
                degree[b] += 1
                x, y = find(distinct[a]), find(distinct[b])
                root[max(x, y)] = min(x, y)
    return [(i, find(i), degree[s]) for i, s in enumerate(sets)]


def near_copies(seed, families, copies):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(2000)]
    out = []
    for _ in range(families):
        base = [r.choice(words) for _ in range(r.randint(20, 200))]
        for _ in range(r.randint(1, copies)):
            near = list(base)
            for _ in range(r.randint(0, len(base) // 40)):
                near[r.randrange(len(near))] = r.choice(words)
            out.append(" ".join(near))
    r.shuffle(out)
    return out


def test_join_by_hand(spark):
    texts = near_copies(3, 60, 12) + ["", "one two", "one two", "a b c d e"]
    rows = sorted(tuple(r) for r in jaccard.join_documents(frame(spark, texts)).collect())
    assert rows == classes_by_hand(texts)


def test_large_families_hold_together(spark, monkeypatch):
    """With tiny buckets everything goes by leaders, dealt to parts; classes stay right."""
    monkeypatch.setattr(jaccard, "BRUTE", 4)
    monkeypatch.setattr(jaccard, "SPLIT", 20)
    texts = near_copies(9, 4, 120)
    rows = sorted(tuple(r) for r in jaccard.join_documents(frame(spark, texts)).collect())
    assert [r[:2] for r in rows] == [r[:2] for r in classes_by_hand(texts)]


def test_linked_pairs_in_a_large_family(spark):
    """All texts share a passage, at a coefficient of 0.75; few pairs share a little more,
    which lifts them over 0.8."""
    shared = [f"s{i}" for i in range(240)]
    own = [[f"t{i}x{j}" for j in range(39)] for i in range(600)]
    for i in range(0, 60, 2):
        own[i + 1][:9] = own[i][:9]
    texts = [" ".join(shared + words) for words in own]
    expected = classes_by_hand(texts)
    assert sum(n for _, _, n in expected) == 60
    assert sorted(tuple(r) for r in jaccard.join_documents(frame(spark, texts)).collect()) == expected


def test_links_of_large_families_are_counted(spark, monkeypatch):
    """Every link counts once, wherever its texts meet: in one or several blocks and buckets."""
    monkeypatch.setattr(jaccard, "SPLIT", 50)
    texts = near_copies(9, 4, 120) + near_copies(10, 30, 8)
    r = random.Random(5)
    base = [f"b{i}" for i in range(300)]
    for i in range(250):
        near = list(base)
        for j in range(r.randint(1, 7)):
            near[r.randrange(300)] = f"n{i}x{j}"
        texts.append(" ".join(near))
    rows = sorted(tuple(r) for r in jaccard.join_documents(frame(spark, texts)).collect())
    assert rows == classes_by_hand(texts)


def test_components_of_a_long_chain(spark):
    key = lambda i: i.to_bytes(2, "big")
    links = [(key(i), key(i + 1)) for i in range(200)] + [(key(1000), key(1001))]
    rows = jaccard.components(spark.createDataFrame(links, "a binary, b binary")).collect()
    roots = {int.from_bytes(r.key, "big"): int.from_bytes(r.root, "big") for r in rows}
    assert roots == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000}


# --- Pipeline -----------------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline
    from eventloom.functions.storage import materialise

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, verdicts = docs.columns, run(spark, "op4_quality_rules")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = materialise(stage(spark, docs, str(DATA)), name)
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == columns and after.keys() <= before.keys()
        if name == "quality_rules":
            assert after.keys() == {d for d, v in verdicts.items() if v.kept}
        elif name == "ngram_jaccard_join":
            order = sorted(before)
            found = classes_by_hand([before[d].text for d in order])
            assert after.keys() == {order[root] for _, root, _ in found}
        elif name == "suffix_array_dedup":
            order = sorted(before)
            kept = covered_by_hand([before[d].text for d in order], 400)
            short = covered_by_hand([before[d].text for d in order], repeats.PASSAGE_BYTES)
            for d, (size, removed, *_), (_, touched, *_) in zip(order, kept, short, strict=True):
                assert touched or after[d].text == before[d].text
                assert len(after[d].text.encode()) <= size - removed
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(DATA)).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}


def test_run_equals_its_stages(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, str(DATA)).collect()
    assert rows and {"sequence_id", "offset"} <= set(rows[0].asDict())
