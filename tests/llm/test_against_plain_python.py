"""Queries over whole tables, compared with plain Python or SQL over the same rows."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from corpus import SF_DIR
from tokenizers import Tokenizer

import corpus_pipeline
from cohortline.llm import near_dedup, packing, suffix_dedup
from cohortline.llm.queries import ORACLE_SQL, QUERIES, table, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def results(spark, name: str, *columns: str) -> dict:
    return {row[0]: tuple(row[c] for c in columns) for row in QUERIES[name](spark, SF_DIR).collect()}


def spans(marked: np.ndarray) -> int:
    return int(np.count_nonzero(marked & np.append(True, ~marked[:-1]))) if len(marked) else 0


def removed_bytes(texts: list[tuple[int, str]]) -> dict:
    seen, expected = set(), {}
    for key, text in texts:
        data = (text or "").encode()
        own = [data[k : k + 50] for k in range(len(data) - 49)]
        marked = np.zeros(len(data), bool)
        for k, piece in enumerate(own):
            if piece in seen:
                marked[k : k + 50] = True
        seen.update(own)
        kept = bytes(np.frombuffer(data, np.uint8)[~marked])
        expected[key] = (len(data), int(marked.sum()), spans(marked), hashlib.sha256(kept).hexdigest())
    return expected


@pytest.mark.parametrize("bucket", [suffix_dedup.BUCKET_BYTES, 20_000])
def test_suffix_dedup(spark, base, monkeypatch, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", bucket)
    found = results(spark, "op1_suffix_dedup", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert found == removed_bytes(base("documents", "doc_id, text"))


@pytest.mark.parametrize("windows", [1, 64, suffix_dedup.SLICE_WINDOWS])
def test_frequent_anchor_is_merged_in_slices(monkeypatch, windows):
    monkeypatch.setattr(suffix_dedup, "SLICE_WINDOWS", windows)
    random = np.random.default_rng(4)
    sources = [random.integers(97, 99, 130).astype(np.uint8) for _ in range(4)]
    blobs, least, stretches = [], {}, []
    for _ in range(5):
        rows = []
        for _ in range(40):
            key, count = int(random.integers(1, 30)), int(random.integers(1, 50))
            low = int(random.integers(0, 130 - count - 48))
            # Few texts, all of one anchor or of one more, so that most windows are shared.
            source = int(random.integers(4))
            text = sources[source][low : low + count + 49]
            rows.append((source // 2, key, 1_000 * len(rows), low, count, text))
            for k in range(count):
                piece = (source // 2, text[k : k + 50].tobytes())
                least[piece] = min(least.get(piece, key), key)
        stretches.append(rows)
        columns = list(zip(*rows, strict=True))
        kinds = (np.uint64, np.int64, np.int64, np.int16, np.int16)
        arrays = [np.array(column, kind) for column, kind in zip(columns, kinds, strict=False)]
        blobs.append(suffix_dedup._pack(**{str(k): a for k, a in enumerate([*arrays, np.concatenate(columns[5])])}))
    for result, rows in zip(suffix_dedup.merge_records(blobs), stretches, strict=True):
        ids, first, last = suffix_dedup._unpack(result, np.int64, np.int64, np.int64)
        found = {(i, place) for i, a, b in zip(ids, first, last, strict=True) for place in range(a, b + 1)}
        assert found == {
            (key, place + k)
            for anchor, key, place, _, count, text in rows
            for k in range(count)
            if least[anchor, text[k : k + 50].tobytes()] < key
        }


def test_suffixes_are_sorted_and_prefixes_exact():
    random = np.random.default_rng(1)
    data = random.integers(97, 99, 3000).astype(np.uint8)
    data[1000:1400], data[2000:2200] = data[200:600], 97
    order, _, slots = suffix_dedup.suffix_ranks(data, 50)
    text = data.tobytes()
    inner = [x for x in order.tolist() if x < 2900]
    assert all(text[a : a + 50] <= text[b : b + 50] for a, b in zip(inner, inner[1:], strict=False))

    def shared(a: int, b: int) -> int:
        k = 0
        while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
            k += 1
        return k

    lengths = suffix_dedup.common_prefixes(data, order, slots)
    for length, slot in zip(lengths.tolist(), slots.tolist(), strict=True):
        assert slot == 0 or length == shared(order[slot], order[slot - 1])


def test_long_texts_are_cut_without_loss(spark, documents, monkeypatch):
    body = "".join(chr(97 + (k * k * 7 + k // 3) % 26) for k in range(3000))
    rows = [(1, body), (2, "x" + body[100:2500] + "y"), (3, body[2000:2049])]
    frame = documents(*rows)
    whole = {row["doc_id"]: tuple(row)[1:5] for row in suffix_dedup.remove_repeats(frame).collect()}
    assert whole == removed_bytes(rows)


def test_decontamination(spark, base):
    windows = defaultdict(set)
    for item, text in base("benchmark", "item_id, text"):
        words = TOKEN.findall(lowered(text))
        for k in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[k : k + 10])].add(str(item))
    lengths, expected = {len(w) for w in windows}, {}
    for key, text in base("documents", "doc_id, text"):
        words, hit, items = TOKEN.findall(lowered(text)), set(), set()
        for size in lengths:
            for k in range(len(words) - size + 1):
                if found := windows.get(tuple(words[k : k + size])):
                    items |= found
                    hit.update(range(k, k + size))
        digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        expected[key] = (len(words), len(hit), len(items), digest, bool(hit))
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert results(spark, "op2_decontaminate", *columns) == expected


def test_language(spark, base):
    found = results(spark, "op3_language_id", "language", "kept")
    declared = dict(base("documents", "doc_id, lang"))
    right = [found[key][0] == lang for key, lang in declared.items()]
    assert np.mean(right) > 0.98
    assert np.mean([kept for _, kept in found.values()]) > 0.98
    pages = results(spark, "llm_page_language", "language")
    assert len(pages) == len(base("pages", "page_id"))


def text_counts(text: str) -> tuple:
    words = WORD.findall(text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    triples = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {j for k in range(len(words) - 2) if triples[tuple(words[k : k + 3])] > 1 for j in (k, k + 1, k + 2)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, len(covered)


def test_quality_rules(spark, base):
    found = results(spark, "op4_quality_rules", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for key, text in base("documents", "doc_id, text"):
        counts = text_counts(text or "")
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert found[key][:6] == (*counts, failed)
        assert not (failed and found[key][6])


def test_quality_classifier_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"select doc_id, quality from '{sf_dir}/labels.parquet'").fetchall())
    rows = QUERIES["op5_quality_classifier"](spark, sf_dir).collect()
    held = [(row["predicted"], labels[row["doc_id"]]) for row in rows if row["held_out"] and row["doc_id"] in labels]
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) for row in rows)
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.9
    assert all(0 <= row["score"] <= 1 for row in rows)


def linked(texts: list[tuple[int, str]], percent: int) -> dict:
    sets, postings, root = {}, defaultdict(list), {}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for key, text in texts:
        words = WORD.findall(lowered(text))
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}
        sets[key], root[key] = own, key
        met = Counter(other for shingle in own for other in postings[shingle])
        for shingle in own:
            postings[shingle].append(key)
        for other, shared in met.items():
            if 100 * shared >= percent * (len(own) + len(sets[other]) - shared):
                one, two = find(key), find(other)
                root[max(one, two)] = min(one, two)
    return {key: (len(own), find(key), find(key) == key) for key, own in sets.items()}


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 2])
def test_near_dedup(spark, base, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "PIVOTS", 2)
    found = results(spark, "op6_near_dedup", "n_shingles", "component_id", "kept")
    assert found == linked(base("documents", "doc_id, text"), 85)


def test_near_dedup_of_a_group_of_edited_copies(spark, documents):
    random = np.random.default_rng(4)
    words = [f"w{k}" for k in range(160)]
    rows = [(0, " ".join(words))]
    for key in range(1, 120):
        edited = list(words)
        for place in random.integers(0, len(words), random.integers(0, 7)):
            edited[place] = f"e{key}"
        rows.append((key, " ".join(edited)))
    found = {row["doc_id"]: (row["n_shingles"], row["component_id"], row["kept"]) for row in near_dedup.link(documents(*rows)).collect()}
    assert found == linked(rows, 85)


def pieces_of(texts: list[tuple[int, str]]) -> dict:
    tokenizer, expected = Tokenizer.from_file(tokenizer_path()), {}
    for key, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            expected[key, piece] = (start, len(part), zlib.crc32(part.tobytes()))
    return expected


def assert_packed(rows: list, expected: dict) -> None:
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(length for _, length, _ in expected.values())
    assert len(sequences) <= 1.02 * total / 4096 + 1


def test_packing(spark, base):
    assert_packed(QUERIES["op7_packing"](spark, SF_DIR).collect(), pieces_of(base("documents", "doc_id, text")))


def test_words_are_encoded_as_texts_are():
    encoder = packing.WordEncoder(tokenizer_path(), cached=40)
    texts = ["It's  the DOG's; don't!! 12,5% ÀÉß ŒUVRE", "", "<|endoftext|> x", "日本 ok", "a b\x85c \x1cd", "İstanbul ǅ ŉ", "é", "x" * 500]
    whole = [encoder.encode_whole(text) for text in texts]
    for _ in range(3):
        assert [ids.tolist() for ids in encoder.encode(texts)] == whole


def test_sequences_of_random_lengths():
    random = np.random.default_rng(2)
    for capacity in (12, 60):
        lengths = Counter(random.integers(1, capacity + 1, 400).tolist())
        kinds = packing.plan_sequences(dict(lengths), capacity)
        packed = Counter()
        for count, parts in kinds:
            assert sum(length * pieces for length, pieces in parts) <= capacity
            for length, pieces in parts:
                packed[length] += count * pieces
        assert packed == lengths


def test_archive(spark, base):
    first, expected = {}, {}
    for key, html in base("pages", "page_id, html"):
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        origin = first.setdefault(digest, key)
        expected[key] = (len(payload), digest, "response" if origin == key else "revisit", None if origin == key else origin)
    assert results(spark, "op8_warc", "payload_bytes", "payload_digest", "record_type", "refers_to") == expected


def test_line_dedup_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    expected = {row[0]: row[1:] for row in db.execute(ORACLE_SQL["op9_line_dedup"]).fetchall()}
    found = {row[0]: tuple(row)[1:] for row in QUERIES["op9_line_dedup"](spark, sf_dir).collect()}
    assert found == expected and sum(row[1] for row in found.values()) > 100


def test_line_dedup_runs_no_python(spark):
    frame = QUERIES["op9_line_dedup"](spark, SF_DIR)
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()


def test_scores_prefer_text_like_the_corpus(spark, documents):
    phrase = "one two three four five six seven eight nine ten".split()
    common = [(k, " ".join(phrase * 30)) for k in range(200)]
    random = np.random.default_rng(0)
    shuffled = (1000, " ".join(random.permutation(phrase * 30)))
    unknown = (1001, " ".join(f"zq{k}" for k in range(300)))
    from cohortline.llm import lm_scoring

    scored = {r["doc_id"]: r for r in lm_scoring.score(documents(*common, shuffled, unknown)).collect()}
    assert scored[0]["mean_log_probability"] > scored[1000]["mean_log_probability"] + 0.5
    assert scored[1000]["mean_log_probability"] > scored[1001]["mean_log_probability"]
    assert scored[0]["n_words"] == 300
    assert scored[0]["log_probability"] == pytest.approx(300 * scored[0]["mean_log_probability"])


def test_words_beyond_the_broadcast_ones_have_their_own_shares(spark, documents, monkeypatch):
    from cohortline.llm import lm_scoring

    # Word k occurs about 1,500 / k times, so many of the words beyond the first 600 occur more than once.
    words = [f"w{k}" for k in range(1, 1_500) for _ in range(1_500 // k)]
    words = np.random.default_rng(1).permutation(words).tolist()
    frame = documents(*((k, " ".join(words[k::40])) for k in range(40)), (40, "w601 w601"), (41, "w1400 w1400"))
    whole = {r["doc_id"]: r["log_probability"] for r in lm_scoring.score(frame).collect()}
    monkeypatch.setattr(lm_scoring, "KEPT_WORDS", 600)
    fewer = {r["doc_id"]: r["log_probability"] for r in lm_scoring.score(frame).collect()}
    assert fewer == pytest.approx(whole, rel=1e-4)


def test_pipeline_stage_by_stage(spark, base):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    sql = ORACLE_SQL["op9_line_dedup"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).toArrow())
        after = docs.collect()
        texts = [(row["doc_id"], row["text"]) for row in before]
        if name == "language_id":
            assert len(after) >= 0.98 * len(before)
        elif name == "line_dedup":
            db = duckdb.connect()
            db.register("documents", spark.createDataFrame(before).toArrow())
            expected = {row[0]: row[3] for row in db.execute(sql).fetchall()}
            assert {row["doc_id"]: row["text"] for row in after} == expected
            assert all(row["n_chars"] == len(row["text"]) for row in after)
        elif name == "near_dedup":
            kept = {key for key, row in linked(sorted(texts), 80).items() if row[2]}
            assert {row["doc_id"] for row in after} == kept
        elif name == "decontamination":
            items = [TOKEN.findall(lowered(text)) for _, text in base("benchmark", "item_id, text")]
            windows = {tuple(words[k : k + 10]) for words in items for k in range(max(1, len(words) - 9))}
            clean = set()
            for key, text in texts:
                words = TOKEN.findall(lowered(text))
                if not any(tuple(words[k : k + n]) in windows for n in {len(w) for w in windows} for k in range(len(words) - n + 1)):
                    clean.add(key)
            assert {row["doc_id"] for row in after} == clean
        else:
            assert_packed(after, pieces_of(texts))
            continue
        assert docs.columns == columns


def word_hash(word: str) -> int:
    from cohortline.llm.lm_scoring import words_of
    from cohortline.llm.textscan import blocks

    return int(words_of(next(blocks(pa.array([word]))))[0].view(np.uint64)[0])


def test_words_of_one_hashed_class_are_told_by_their_surroundings(spark, documents):
    from cohortline.llm import lm_scoring
    from cohortline.llm.store import Store
    from cohortline.llm.textscan import blocks

    x, y = [w for w in (f"rare{k}" for k in range(200)) if word_hash(w) % lm_scoring.HASHED_CLASSES == 5][:2]
    fillers = [f"filler{k}" for k in range(70)]
    text = " ".join([*fillers * 13, f"left {x} filler1 right {y} filler2 " * 10])
    frame = documents(*((k, text) for k in range(100)))
    words, _ = lm_scoring.vocabulary(frame, Store(frame, "test"))
    w = lm_scoring.unpack(lm_scoring.train(frame, words, 6))

    def score(given: str) -> float:
        """Log-probability of the second of three words."""
        hashes, first = lm_scoring.words_of(next(blocks(pa.array([given]))))
        classes, inputs, shares, _ = words.look_up(hashes)
        targets = lm_scoring.Targets.of(hashes, classes)
        return (shares + lm_scoring.log_probabilities(w, words.digits, lm_scoring.contexts(inputs, first), targets))[1]

    assert score(f"left {x} filler1") > score(f"left {y} filler1") + 0.1
    assert score(f"right {y} filler2") > score(f"right {x} filler2") + 0.1


def test_probabilities_of_all_words_add_up_to_one(spark, documents, monkeypatch):
    from cohortline.llm import lm_scoring
    from cohortline.llm.store import Store

    monkeypatch.setattr(lm_scoring, "KEPT_WORDS", 500)
    frame = documents(*((k, " ".join(f"w{n}" for n in range(1, 2_000) if n % (k + 1) == 0)) for k in range(30)))
    words, counts = lm_scoring.vocabulary(frame, Store(frame, "test"))
    counted = counts.toArrow()
    hashes, n = counted["word"].to_numpy().copy(), counted["n"].to_numpy()
    random = np.random.default_rng(2)
    w = lm_scoring.unpack(lm_scoring.initial())
    w["digits"] = random.normal(0, 0.5, w["digits"].shape)
    classes, _, shares, beyond = words.look_up(hashes)
    targets = lm_scoring.Targets.of(hashes, classes)
    rare = beyond[targets.hashed]
    shares[targets.hashed[rare]] -= np.log(words.digits[targets.rows[rare], targets.values[rare]]).sum(1)
    shares += np.where(beyond, np.log(n), 0)
    assert 0 < beyond.sum() < len(hashes) == 1_999
    around = np.tile(random.integers(0, lm_scoring.INPUTS + 1, len(lm_scoring.OFFSETS)), (len(hashes), 1))
    logs = shares + lm_scoring.log_probabilities(w, words.digits, around, targets)
    # All classes have words here but for hashed ones, of which some may have none.
    _, _, raised, sums = lm_scoring._forward(w, around[:1])
    assert np.exp(logs).sum() == pytest.approx((raised[0] / sums[0])[np.unique(classes)].sum(), rel=1e-4)
    assert np.exp(logs).sum() > 0.95


def test_gradients_are_those_of_the_scores():
    from cohortline.llm import lm_scoring

    random = np.random.default_rng(4)
    words = random.integers(-(1 << 62), 1 << 62, 300)
    hashed = words.view(np.uint64)
    classes = np.where(random.random(300) < 0.5, random.integers(0, 64, 300), 64 + (hashed % np.uint64(32)).astype(int))
    leaves = np.bincount((hashed % np.uint64(lm_scoring.LEAVES)).astype(int), minlength=lm_scoring.LEAVES).astype(float)
    shares, targets = lm_scoring.digit_shares(leaves), lm_scoring.Targets.of(words, classes)
    around = lm_scoring.contexts(random.integers(0, lm_scoring.INPUTS, 300), np.arange(0, 301, 50))
    weights = {name: random.normal(0, 0.3, shape) for name, shape in lm_scoring.SHAPES.items()}

    def score(name, place, by):
        moved = {**weights, name: weights[name].copy()}
        moved[name][place] += by
        return lm_scoring.log_probabilities(moved, shares, around, targets).mean()

    # With squares as large as these, a step is the gradient times a fixed rate.
    after, size = {name: value.copy() for name, value in weights.items()}, 1e12
    lm_scoring.train_step(after, {name: np.full(shape, size) for name, shape in lm_scoring.SHAPES.items()}, shares, around, targets)
    for name in lm_scoring.SHAPES:
        gradient = (after[name] - weights[name]) / lm_scoring.RATE * np.sqrt(size)
        place = np.unravel_index(np.argmax(np.abs(gradient)), gradient.shape)
        assert gradient[place] == pytest.approx((score(name, place, 1e-5) - score(name, place, -1e-5)) / 2e-5, rel=1e-2), name
