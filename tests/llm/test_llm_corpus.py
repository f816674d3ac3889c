"""Operators that compare documents with each other, against brute force and SQL."""

from __future__ import annotations

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tidefare.llm import components, line_dedup, minhash, mixing, suffix_groups
from tidefare.llm.common import identified, stored
from tidefare.llm.queries import QUERIES
from tidefare.llm.sql import SQL

from .conftest import BASE, ROWS, sentence


def rows_of(frame):
    return [row.asDict() for row in frame.collect()]


def texts_of(spark, folder):
    return {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}


# Components and near duplicates

def test_components_of_a_path_a_star_and_a_ring(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(300, 301), (301, 302), (302, 300), (5, 5), (301, 300)]
    found = {r["node"]: r["component"] for r in rows_of(components.connected_components(spark.createDataFrame(links, "a long, b long")))}
    assert all(found[k] == 100 for k in range(100, 141)) and all(found[k] == 7 for k in range(200, 260))
    assert {found[k] for k in (300, 301, 302)} == {300}
    assert rows_of(components.connected_components(spark.createDataFrame([], "a long, b long"))) == []


def shingle_sets(texts, width):
    out = {}
    for key, text in texts.items():
        words = (text or "").encode().lower().split()
        out[key] = {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()
    return out


def brute_components(texts, width):
    sets, parent = shingle_sets(texts, width), {key: key for key in texts}

    def root(key):
        while parent[key] != key:
            key = parent[key]
        return key

    holders = {}
    for key in sorted(texts):
        near = Counter(other for shingle in sets[key] for other in holders.get(shingle, ()))
        for other, both in near.items():
            if 100 * both >= 80 * (len(sets[key]) + len(sets[other]) - both):
                low, high = sorted((root(key), root(other)))
                parent[high] = low
        for shingle in sets[key]:
            holders.setdefault(shingle, []).append(key)
    return {key: root(key) for key in texts}, sets


def test_near_duplicates_equal_brute_force(spark, gate):
    texts = texts_of(spark, gate)
    expected, sets = brute_components(texts, 4)
    found = rows_of(QUERIES["op8_circulant_minhash"](spark, gate))
    assert len(found) == len(texts)
    for r in found:
        key = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[key]), expected[key], expected[key] == key)


def test_chains_in_large_buckets_are_not_lost(spark, monkeypatch):
    """Near copies that drift: neighbours are linked, the ends are not like the smallest one. Small blocks make every path run."""
    monkeypatch.setattr(minhash, "BLOCK", 7)
    monkeypatch.setattr(minhash, "HUB_ROWS", 5)
    words = sentence(31, 100).split()
    texts = {}
    for k in range(60):
        texts[1000 - k if k % 2 else k] = " ".join([f"new{k}x{j}" for j in range(k // 2)] + words[k // 2:])
    expected, _ = brute_components(texts, 5)
    found = {r["doc_id"]: r["component_id"] for r in rows_of(minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))}
    assert found == expected


def test_near_duplicates_of_odd_rows(docs, no_docs):
    found = rows_of(minhash.near_duplicates(docs))
    assert len(found) == len(ROWS)
    by_id = {r["doc_id"]: r for r in found}
    assert {by_id[k]["component_id"] for k in (1, 2, 3, 16)} == {1}
    assert by_id[6] == {"doc_id": 6, "n_shingles": 0, "component_id": 6, "kept": True} and by_id[7]["kept"] and by_id[9]["n_shingles"] == 1
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    left = minhash.one_of_each(docs)
    assert left.columns == docs.columns and {2, 3, 16}.isdisjoint({r["doc_id"] for r in rows_of(left)})
    assert rows_of(minhash.near_duplicates(no_docs)) == []


def test_signature_coordinates_estimate_similarity():
    one = np.unique(np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    other = np.unique(np.concatenate([one[:800], one[:200] + np.uint64(1)]))
    signature = minhash.signatures([one, other], 512)
    assert abs((signature[0] == signature[1]).mean() - 800 / 1200) < 0.1


# Repeated passages

def brute_removed(texts, window=20):
    seen, out = set(), {}
    for key in sorted(texts):
        words = (texts[key] or "").encode().split()
        gone = [False] * len(words)
        for start in range(len(words) - window + 1):
            run = tuple(words[start:start + window])
            if run in seen:
                gone[start:start + window] = [True] * window
            seen.add(run)
        kept = [word for word, flag in zip(words, gone) if not flag]
        out[key] = (len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


@pytest.mark.parametrize("limits", [{}, {"block": 5000, "most": 300}], ids=["production", "small groups"])
def test_repeats_equal_brute_force(spark, gate, limits):
    docs = spark.read.parquet(f"{gate}/documents.parquet")
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows_of(suffix_groups.remove_repeats(docs, **limits))}
    assert found == brute_removed(texts_of(spark, gate))


def test_repeats_of_odd_rows(docs, no_docs, monkeypatch):
    expected = brute_removed({key: text for key, text, *_ in ROWS if key is not None})
    for most in (10, 0):  # with and without a broadcast of ids
        monkeypatch.setattr(suffix_groups, "BROADCAST_IDS", most)
        found = rows_of(suffix_groups.remove_repeats(docs))
        assert len(found) == len(ROWS)
        assert all((r["n_words"], r["n_removed"], r["kept_sha256"]) == expected[r["doc_id"]] for r in found if r["doc_id"] is not None)
    assert rows_of(suffix_groups.remove_repeats(no_docs)) == []


def test_prefixes_split_frequent_words_and_ranges():
    counts = np.zeros(suffix_groups.CELLS, np.int64)
    counts[5], counts[700], counts[701], counts[9000] = 40, 90, 80, 1000
    group_of, splits = suffix_groups.prefix_groups(counts, 100)
    assert group_of[700] != group_of[701] and splits[group_of[9000]] == 10
    sizes = np.bincount(group_of, weights=counts, minlength=len(splits)) / splits
    assert sizes.max() <= 100


#: One doc_id with different texts, two null ids, copies, and lines that stand nowhere else.
SHARED_IDS = [
    (1, "alpha beta gamma delta"),
    (2, "x y z\nalpha beta gamma delta"),
    (2, "own first\nown other line two"),
    (2, "own first\nown other line two"),
    (None, sentence(41, 70) + "\nfirst line without an id"),
    (None, "second line without an id\n" + sentence(42, 50)),
    (None, None),
    (3, sentence(41, 60)),
    (3, "three words only"),
    (3, sentence(42, 45) + " " + sentence(43, 140)),
    (4, sentence(43, 140)),
    (4, ""),
]


def by_text(spark, rows):
    """The distinct rows in the operators' order, with numbers as ids."""
    from pyspark.sql import functions as F

    ordered = spark.createDataFrame(rows, "doc_id long, text string").distinct().orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return [(row["doc_id"], row["text"]) for row in ordered.collect()]


def test_different_texts_under_one_id_are_documents_of_their_own(spark):
    docs = spark.createDataFrame(SHARED_IDS, "doc_id long, text string").repartition(3)
    ordered = by_text(spark, SHARED_IDS)
    texts = dict(enumerate(text for _, text in ordered))
    gone, repeats = similar_lines(texts), brute_removed(texts)
    lines, passages = {}, {}
    for number, row in enumerate(ordered):
        lines[row] = None if row[1] is None else kept_text(row[1], gone[number])
        passages[row] = repeats[number]
    expected = Counter((key, lines[key, text]) for key, text in SHARED_IDS)
    assert Counter((r["doc_id"], r["text"]) for r in rows_of(line_dedup.dedup_lines(docs))) == expected
    found = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows_of(suffix_groups.remove_repeats(docs)))
    assert found == Counter((key, *passages[key, text]) for key, text in SHARED_IDS)
    assert sum(n for _, n, _ in repeats.values()) > 100 and any(gone.values())


# Lines

def similar_lines(texts):
    """The removed line numbers of each document, by comparing every line with all before it."""
    seen, out = [], {}
    for key in sorted(texts, key=lambda k: (k is not None, k or 0)):
        out[key] = []
        for number, line in enumerate((texts[key] or "").split("\n")):
            words = set(line.encode().split())
            if words:
                if any(100 * len(words & other) >= 80 * len(words | other) for other in seen):
                    out[key].append(number)
                seen.append(words)
    return out


def kept_text(text, gone):
    return "\n".join(line for k, line in enumerate((text or "").split("\n")) if k not in gone)


def test_lines_of_odd_rows(docs, no_docs):
    texts = {key: text for key, text, *_ in ROWS}
    expected = similar_lines(texts)
    deduped = line_dedup.dedup_lines(docs)
    assert deduped.columns == docs.columns
    found = rows_of(deduped)
    assert len(found) == len(ROWS)
    for r in found:
        assert r["text"] == (None if texts[r["doc_id"]] is None else kept_text(texts[r["doc_id"]], expected[r["doc_id"]]))
        assert r["gone"] == "extra"
    assert rows_of(line_dedup.dedup_lines(no_docs)) == [] == rows_of(line_dedup.dedup_report(no_docs))


def test_similar_lines_equal_brute_force(spark, monkeypatch):
    """Families of lines at similarities around the threshold, so that closest partners often fail."""
    texts = {}
    for family in range(6):
        words = sentence(50 + family, 24).split()
        for k in range(25):
            changed = [f"{word}q{(k * 31 + j) % 9}" if (j * 7 + k * family) % 11 < k % 5 else word for j, word in enumerate(words)]
            texts[family * 100 + (k * 13) % 100] = " ".join(changed) + "\n" + " ".join(changed[:3 + k % 4])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected = similar_lines(texts)
    for most, short in ((400_000, 64), (0, 2)):  # the second leaves many partners to the second join
        monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", most)
        monkeypatch.setattr(line_dedup, "SHORT", short)
        found = {r["doc"]: sorted(r["gone"]) for r in rows_of(line_dedup.removed_lines(identified(docs)))}
        assert found == {key: gone for key, gone in expected.items() if gone}


def test_interleaved_families_equal_brute_force(spark):
    """Three families of similar lines that share a rare token, one line after the other, past the first lines of the group."""
    texts = []
    for k in range(300):
        words = sentence(700 + k % 3, 24).split()
        words[k % 5] = f"own{k}"
        texts.append((k, "raretoken " + " ".join(words)))
    docs = identified(spark.createDataFrame(texts, "doc_id long, text string"))
    removed = {r["doc"] for r in rows_of(line_dedup.removed_lines(docs))}
    assert removed == {key for key, gone in similar_lines(dict(texts)).items() if gone}


def test_no_table_of_the_line_join_holds_pairs(spark, monkeypatch):
    """What is stored follows the entries, however many lines of a family are nearly similar."""
    # Any two lines share 21 of 27 words: too few, but bitmaps often let them pass.
    texts = [(k, " ".join([*(f"word{j}" for j in range(21)), *(f"own{k}x{j}" for j in range(3))])) for k in range(800)]
    texts.append((800, texts[700][1] + " more"))
    rows = {}

    def counted(frame, label, stored=line_dedup.stored):
        table = stored(frame, label)
        rows[label] = max(rows.get(label, 0), table.count())
        return table

    monkeypatch.setattr(line_dedup, "stored", counted)
    monkeypatch.setattr(line_dedup, "SHORT", 2)
    removed = {r["doc"] for r in rows_of(line_dedup.removed_lines(identified(spark.createDataFrame(texts, "doc_id long, text string"))))}
    assert removed == {key for key, gone in similar_lines(dict(texts)).items() if gone} == {800}
    assert rows["lines-untried"] > 0
    assert max(rows.values()) <= 801 * 5  # a line of 24 words has 5 entries


def test_full_sets_travel_only_with_entries_that_meet_another(spark, monkeypatch):
    # Three of a line's five entries are words of its own, which meet nothing.
    texts = [(k, " ".join([*(f"word{j}" for j in range(21)), *(f"own{k}x{j}" for j in range(3))])) for k in range(200)]
    rows = {}

    def counted(frame, label, stored=line_dedup.stored):
        table = stored(frame, label)
        rows[label] = table.count()
        return table

    monkeypatch.setattr(line_dedup, "stored", counted)
    monkeypatch.setattr(line_dedup, "SHORT", 2)
    assert rows_of(line_dedup.removed_lines(identified(spark.createDataFrame(texts, "doc_id long, text string")))) == []
    assert 0 < rows["lines-meeting"] * 2 <= rows["lines-untried"]


def test_numbers_of_a_line_are_sorted_without_boxes(spark):
    docs = spark.createDataFrame([("a b a  c",), (" c b a ",), ("a\tb\x0bc\rc",), ("",), (None,)], "text string")
    found = docs.select("text", line_dedup.token_keys("text", line_dedup.token_ranks(docs)).alias("keys"))
    assert not found.schema["keys"].dataType.containsNull
    keys = {r["text"]: r["keys"] for r in found.collect()}
    assert keys.pop("") == [] and keys.pop(None) is None
    assert len({tuple(found) for found in keys.values()}) == 1 and len(set(keys["a b a  c"])) == 3 and keys["a b a  c"] == sorted(keys["a b a  c"])


def test_words_of_texts_and_line_ends_without_translate(spark):
    from conftest import plan_text

    texts = [None, "", " ", "\n\n", "a b\nc\n\n a", "\na\n", "a\tb\nc", "\x0ba\x0cb\r\nc d\x1ce", "Größe\nüber  東京\n"]
    rows = spark.createDataFrame([(text,) for text in texts], "text string").select("text", line_dedup.tokens("text").alias("words"))
    assert {r["text"]: r["words"] for r in rows.collect()} == {
        text: None if text is None else [word.decode() for word in text.encode().split()] for text in texts
    }
    condition = plan_text(rows).split("Contains(text")
    assert len(condition) == 1 + 4 and not any(part.startswith((", \n", ",\n")) for part in condition[1:])


# Mixing

def filled(sizes, weights, cap=3):
    """Water-filling by repeated clamping."""
    targets, left, active = {}, sum(sizes.values()), dict(weights)
    while active:
        level = left / sum(active.values())
        over = [key for key in active if cap * sizes[key] <= level * active[key]]
        if not over:
            return targets | {key: level * weight for key, weight in active.items()}
        for key in over:
            targets[key] = cap * sizes[key]
            left -= targets[key]
            del active[key]
    return targets


def test_targets_and_drawn_words(spark, gate):
    frame = mixing.mix(spark.read.parquet(f"{gate}/documents.parquet"))
    found = frame.toPandas()
    sources = {row["doc_id"]: row["source"] for row in spark.read.parquet(f"{gate}/documents.parquet").collect()}
    found["source"] = found["doc_id"].map(sources)
    sizes = found.groupby("source")["size"].sum().to_dict()
    expected = filled(sizes, {name: k % 3 + 1 for k, name in enumerate(sorted(sizes))})
    for name, own in found.groupby("source"):
        assert own["target"].iloc[0] == pytest.approx(expected[name])
        assert abs(own["taken"].sum() - expected[name]) <= own["size"].max()
    assert (found["taken"] <= 3 * found["size"]).all()
    again = mixing.mix(spark.read.parquet(f"{gate}/documents.parquet").repartition(5)).toPandas()
    assert found.set_index("doc_id")["taken"].sort_index().equals(again.set_index("doc_id")["taken"].sort_index())


def test_small_sources_are_clamped_and_odd_rows_counted(docs, no_docs):
    found = rows_of(mixing.mix(docs))
    assert len(found) == len(ROWS)
    sizes = Counter()
    for key, text, _, source in ROWS:
        sizes[source] += len((text or "").encode().split())
    names = sorted((name for name in sizes if name), key=str.encode) + [None]
    expected = filled(dict(sizes), {name: k % 3 + 1 for k, name in enumerate(names)})
    source_of = {key: source for key, _, _, source in ROWS}
    assert all(r["target"] == pytest.approx(expected[source_of[r["doc_id"]]]) for r in found)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    times = Counter(r["doc_id"] for r in rows_of(mixed))
    copies = Counter()
    for r in found:
        copies[r["doc_id"]] += r["copies"]
    assert times == Counter({key: n for key, n in copies.items() if n}) and {r["place"] for r in rows_of(mixed)} == {"extra"}
    assert rows_of(mixing.mix(no_docs)) == [] == rows_of(mixing.mixed_documents(no_docs))


@pytest.mark.parametrize("counts", [(6, 6), (9, 9, 9, 3), (30, 30)])
def test_whole_targets_are_drawn_exactly(spark, tmp_path, monkeypatch, counts):
    rows, key = [], 0
    for name, count in zip("abcd", counts):
        for _ in range(count):
            key += 1
            rows.append((key, "word", "en", name))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = Counter(database.execute(SQL["op10_water_filling"]).fetchall())
    for bits in (mixing.CELL_BITS, 29, 0):
        monkeypatch.setattr(mixing, "CELL_BITS", bits)
        found = rows_of(mixing.mix(frame))
        taken, targets = Counter(), {}
        for r in found:
            source = rows[r["doc_id"] - 1][3]
            taken[source] += r["taken"]
            targets[source] = r["target"]
        assert all(abs(taken[source] - target) <= 0.5 for source, target in targets.items())
        assert Counter((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in found) == expected
        assert mixing.mixed_documents(frame).count() == sum(taken.values())


# SQL and the pipeline

@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, gate, name):
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{gate}/documents.parquet'")
    result = database.execute(SQL[name])
    columns = [column[0] for column in result.description]
    frame = QUERIES[name](spark, gate)
    assert sorted(frame.columns) == sorted(columns)
    assert Counter(tuple(row) for row in frame.select(columns).collect()) == Counter(result.fetchall())


def test_native_operators_run_no_python(spark, gate):
    from conftest import plan_text

    for name in ("op4_prefix_lines", "op10_water_filling"):
        assert "Python" not in plan_text(QUERIES[name](spark, gate)) and "Arrow" not in plan_text(QUERIES[name](spark, gate))


def test_pipeline_stages_decide_on_what_they_get(spark, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "mix", "pack"]
    current, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        current = stored(stage(spark, current, ""), f"test-{name}")
        seen[name] = rows_of(current)
        if name != "pack":
            assert current.columns == docs.columns
    assert {6, 7, 8, 15}.isdisjoint(r["doc_id"] for r in seen["language"])
    texts = {r["doc_id"]: r["text"] for r in seen["language"]}
    gone = similar_lines(texts)
    kept = {key: kept_text(text, gone[key]) for key, text in texts.items()}
    assert {r["doc_id"]: r["text"] for r in seen["lines"]} == {key: text for key, text in kept.items() if text.split()}
    assert texts[1] == BASE and 3 not in {r["doc_id"] for r in seen["lines"]}
    left = {r["doc_id"]: r["text"] for r in seen["lines"]}
    components_, _ = brute_components({key: text for key, text in left.items() if key is not None}, 5)
    assert {r["doc_id"] for r in seen["near_duplicates"] if r["doc_id"] is not None} == {key for key, own in components_.items() if key == own}
    tokens = Counter()
    for r in seen["pack"]:
        tokens[r["doc_id"]] += r["length"]
    assert set(tokens) == {r["doc_id"] for r in seen["mix"]}


def test_pipeline_runs_on_the_documents(spark, gate):
    found = corpus_pipeline.run(spark, gate).toPandas()
    assert len(found) > 500 and (found["length"] > 0).all() and (found["doc_tokens"] > 1).all()
    total = found.groupby("sequence_id")["length"].sum()
    assert total.max() <= 4096 and (total == 4096).mean() > 0.9
