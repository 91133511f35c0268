"""Spelling variants, whitening and sharding: against SQL, brute force and numpy, and odd input."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import connect, differences
from corpus import ODD, SF_DIR

from cohortline.llm import queries, sharding, spelling, whitening
from cohortline.llm.store import Store

EMBEDDINGS = "vec_id bigint, embedding array<float>, component string, x string, n string"


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op13_sharding"])
def test_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLE_SQL[name]) == []


# Spelling


def brute_counts(rows) -> Counter:
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return Counter({word: n for word, n in counts.items() if n >= 3 and len(word) >= 5})


def one_edit(a: str, b: str) -> bool:
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def test_counts_equal_plain_python(documents, base):
    given = [*base("documents", "doc_id, text")[:60], *ODD, (50_002, "Ünïcödé " * 3 + "×÷×÷× " * 4 + "日本語日本語 " * 3, None, None)]
    found = {row["word"]: row["n"] for row in spelling.word_counts(documents(*given)).collect()}
    assert found == dict(brute_counts(given))
    assert "×÷×÷×" in found and "x" * 200_000 not in found


def test_a_very_long_run_is_a_word(documents):
    given = [(k, "y" * 100_000 + " " + "y" * 99_999, "en", "web") for k in range(4)]
    found = {row["word"]: row for row in spelling.variants(documents(*given), noise=None).collect()}
    assert {len(word): row["n_near"] for word, row in found.items()} == {100_000: 1, 99_999: 1}


@pytest.mark.parametrize("most_pairs", [1, 7, 1_000])
def test_near_words_equal_brute_force_however_small_the_groups(spark, documents, most_pairs):
    random = np.random.default_rng(5)
    words = {"".join(random.choice(list("abé"), 5 + k % 3)) for k in range(400)}
    # Chunks that very many words share.
    words |= {"prefix" + "".join(random.choice(list("xyz"), 4)) for _ in range(80)}
    counted = spark.createDataFrame([(word, 3 + len(word)) for word in sorted(words)], "word string, n bigint")
    found = [(r["one"], r["two"]) for r in spelling.near_words(counted, Store(counted, "t"), most_pairs).collect()]
    assert len(found) == len(set(found))
    expected = {frozenset((a, b)) for a in words for b in words if a < b and one_edit(a, b)}
    assert {frozenset(pair) for pair in found} == expected and len(found) == len(expected)


def test_forms_chain_to_the_root_and_ties_go_to_the_first(documents):
    counts = {"letter": 40, "lettre": 50, "lettr": 3, "leter": 8, "later": 16, "liter": 16, "litter": 3, "single": 3}
    text = " ".join(" ".join([word] * n) for word, n in counts.items())
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(documents((1, text)), noise=None).collect()}
    assert found["leter"] == ("letter", "letter", 8, 4, 40)
    assert found["lettr"] == ("lettre", "lettre", 3, 3, 50)
    # "litter" is near "letter" (40) and "liter" (16).
    assert found["litter"] == ("letter", "letter", 3, 2, 40)
    assert found["later"] == (None, "later", 16, 2, None)
    assert found["single"] == (None, "single", 3, 0, None)
    tied = {"aaaaab": 3, "aaaaac": 6, "aaaaad": 6}
    text = " ".join(" ".join([word] * n) for word, n in tied.items())
    found = {r["word"]: r["form"] for r in spelling.variants(documents((1, text)), noise=None).collect()}
    assert found == {"aaaaab": "aaaaac", "aaaaac": None, "aaaaad": None}


def test_spelling_of_odd_and_empty_tables(spark, documents):
    assert spelling.variants(documents(*ODD)).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    empty = documents(*ODD).where("false")
    assert spelling.variants(empty).count() == 0


# Whitening


@pytest.mark.parametrize(("size", "rank", "rows"), [(24, 24, 200), (24, 5, 90), (6, 6, 4), (1, 1, 3)])
def test_rank_one_updates_equal_a_direct_decomposition(size, rank, rows):
    random = np.random.default_rng(size + rank)
    given = random.normal(size=(rows, rank)) @ random.normal(size=(rank, size)) * 10
    one, two = whitening.Spectrum.empty(size), whitening.Spectrum.empty(size)
    for k, row in enumerate(given):
        (one if k % 2 else two).add(row)
    one.merge(whitening.Spectrum.from_bytes(two.to_bytes()))
    scatter = given.T @ given
    top = np.linalg.eigvalsh(scatter)[-1]
    assert np.abs(one.values - np.linalg.eigvalsh(scatter)).max() < 1e-11 * top
    assert np.abs(one.vectors.T @ one.vectors - np.eye(size)).max() < 1e-10
    assert np.abs((one.vectors * one.values) @ one.vectors.T - scatter).max() < 1e-11 * top


def test_equal_eigenvalues_and_repeated_vectors_are_deflated():
    s = whitening.Spectrum.empty(3)
    for row in [*np.eye(3), *2 * np.eye(3), np.zeros(3)]:
        s.add(row)
    assert np.allclose(s.values, 5)
    for _ in range(50):
        s.add(np.array([1.0, 1.0, 0.0]))
    assert np.allclose(s.values, [5, 5, 105])


def whitened_in_numpy(vectors: np.ndarray):
    x = np.floor(64 * vectors.astype(np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = (n * fit - sums) / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    top = slice(None, -17, -1)
    return n, ((n * x - sums) ** 2).sum(1), ((n * x - sums) / n) @ turn[:, top] / np.sqrt(values[top]), values[top] / values.sum()


def test_whitening_equals_numpy(spark, base):
    rows = base("embeddings", "vec_id, embedding")
    found = queries.op12_embedding_whitening(spark, SF_DIR).orderBy("vec_id", "component").toPandas()
    n, deviation, whitened, explained = whitened_in_numpy(np.array([row[1] for row in rows], np.float32))
    ours = found["whitened"].to_numpy().reshape(-1, 16)
    signs = np.sign((ours * whitened).sum(0))
    assert np.abs(ours - whitened * signs).max() < 1e-9
    assert set(found["n"]) == {n} and found["deviation"].tolist() == np.repeat(deviation, 16).tolist()
    assert np.abs(found["explained"].to_numpy()[:16] / explained - 1).max() < 1e-10
    assert found["component"].tolist() == list(range(1, 17)) * len(rows) and found["identity_error"].max() < 1e-9


def test_whitening_leaves_out_broken_vectors_and_counts_copies_once(spark):
    good = [(k, [k * 1.5, (k * k) % 7 * 1.0, (k * 3) % 5 * 1.0]) for k in range(30)]
    odd = [(None, good[3][1]), (3, good[3][1]), (90, None), (91, [1.0, None, 2.0]), (92, [1.0, float("nan"), 2.0]), (93, [1.0, float("inf"), 2.0]), (94, []), (95, [1.0])]
    frame = spark.createDataFrame([(*row, "a", "b", "c") for row in good + odd], EMBEDDINGS).repartition(5)
    found = whitening.whiten(frame).toPandas()
    assert set(found["n"]) == {30} and len(found) == 32 * 3 and set(found["component"]) == {1, 2, 3}
    assert set(found["vec_id"].dropna()) == set(range(30)) and found["vec_id"].isna().sum() == 3
    copies = found[found["vec_id"].isna() | (found["vec_id"] == 3)]
    assert copies.groupby("component")["whitened"].nunique().tolist() == [1, 1, 1]


def test_whitening_without_variance_or_rows(spark):
    same = spark.createDataFrame([(k, [1.0, 2.0], "", "", "") for k in range(5)], EMBEDDINGS)
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(same.where("false")).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    # Of rank one: one component.
    line = spark.createDataFrame([(k, [k * 1.0, k * 2.0], "", "", "") for k in range(5)], EMBEDDINGS)
    assert {(r["component"], round(r["explained"], 9)) for r in whitening.whiten(line).collect()} == {(1, 1.0)}


def test_deviations_beyond_a_long_are_null():
    model = whitening.Whitening(1 << 20, np.zeros(2, np.int64), np.ones(1), np.ones((2, 1)), np.ones(1), 0.0)
    assert model.deviation(np.array([[3, 4], [1 << 30, 1 << 30]])) == [25 << 40, None]


# Sharding


def test_shards_hold_the_mixture(documents):
    sources = {"hot": 700, "web": 200, "book": 83, None: 17} | {f"host{k}": 1 for k in range(96)}
    given = [(k, f"text {k}", "en", name) for k, name in enumerate(name for name, n in sources.items() for _ in range(n))]
    frame = documents(*given)
    found = sharding.interleave(sharding.measured(frame), shards=8).collect()
    sizes = Counter(r["shard"] for r in found)
    assert len(found) == len(given) and set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))
    share = 1 / len(sources)
    for name, n in sources.items():
        held = Counter(r["shard"] for r in found if r["source"] == name)
        slack = 1 + len(sources) * n / len(given) if share else 1
        assert all(abs(held[shard] - n / 8) <= slack for shard in range(8)), name
    # Sources of one row are not heaped in one shard.
    single = Counter(r["shard"] for r in found if (r["source"] or "").startswith("host"))
    assert len(single) == 8 and max(single.values()) < 30


def test_sharding_of_odd_rows(documents):
    frame = documents(*ODD, *[(None, None, None, None)] * 40)
    found = sharding.shard_documents(frame).collect()
    assert len(found) == len(ODD) + 40 and {r["law"] for r in found} == {"rows"} and {r["grown_shard"] for r in found} == {None}
    assert {(r["size"], r["text_crc32"]) for r in found if r["doc_id"] is None and r["size"] == 8} == {(8, 0)}
    long = next(r for r in found if r["doc_id"] == 6)
    text = next(row[1] for row in ODD if row[0] == 6)
    assert (long["size"], long["text_crc32"]) == (len(text.encode()) + 8, zlib.crc32(text.encode()))
    assert sharding.shard_documents(frame.where("false")).count() == 0
    clashing = sharding.interleave(sharding.measured(frame).withColumn("shard", frame["lang"]).withColumn("place", frame["lang"]))
    assert clashing.columns.count("shard") == 1 and "place" in clashing.columns
    assert sorted(r["shard"] for r in sharding.interleave(sharding.measured(frame), shards=1).collect()) == [0] * len(found)
    with pytest.raises(ValueError, match="shard"):
        sharding.interleave(frame, shards=0)


def test_seed_decides_the_order(documents):
    frame = documents(*[(k, f"text {k}", "en", "web") for k in range(200)])
    place = lambda seed: {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_documents(frame.repartition(7), seed=seed).collect()}
    assert place(1) == place(1) != place(2)


def test_written_shards_hold_whole_documents_in_order(documents, tmp_path):
    frame = documents(*ODD, *[(k, f"text {k}", "en", "web") for k in range(100, 400)])
    written = sharding.write_shards(frame, str(tmp_path / "shards"), shards=4)
    assert sorted(map(repr, (r["text"] for r in written.collect()))) == sorted(map(repr, (r["text"] for r in frame.collect())))
    assert set(frame.columns) <= set(written.columns)
    slots = [r["slot"] for r in written.where("shard = 2").collect()]
    assert sorted(slots) == list(range(len(slots)))
