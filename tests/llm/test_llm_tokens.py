"""Alignment, periodic runs and token tables against brute force and round trips."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidefare.llm import alignment, id_coder, periodic_runs, token_files
from tidefare.llm.byte_tokens import ByteTokens, spaced_words
from tidefare.llm.queries import QUERIES

from .conftest import ROWS, sentence

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    "", " ", "a", "  a", "a  b   c ", "a\n b\n\n  c\td", "x" * 700, "<|endoftext|> a<|endoftext|>b", "▁x y", "日本 語 の　文", "it's we'll  don't\r\n", "\x00 a\x1c b",
    "ends in space ", " \n ", "a  b  c", "é ́x ü", "one two\n\nthree  four", "<s>x</s> <0x0A> <unk>",
]


def rows_of(frame):
    return [row.asDict(recursive=True) for row in frame.collect()]


def texts_of(spark, folder):
    return {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}


# Alignment

class Brute:
    """Whole texts encoded at once, tokens compared pair by pair."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTES)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [byte for byte in range(256) if byte not in shown]
        self.byte_of = {chr(byte): byte for byte in shown} | {chr(256 + k): byte for k, byte in enumerate(hidden)}

    def tokens(self, text):
        encoded = self.a.encode(" " + text, add_special_tokens=False)
        a = [(index, bytes(self.byte_of[c] for c in token)) for index, token in zip(encoded.ids, encoded.tokens)]
        b = []
        for index in self.b.encode(text):
            piece = self.b.id_to_piece(index)
            b.append((index, bytes([int(piece[3:5], 16)]) if self.b.is_byte(index) else piece.replace("▁", " ").encode()))
        own = (" " + text).encode()
        return (a, b) if text and all(b"".join(value for _, value in side) == own for side in (a, b)) else ([], [])

    def aligned(self, text):
        """(n_a, n_b, groups, links)"""
        places = []
        for side in self.tokens(text or ""):
            at, spans = 0, []
            for index, value in side:
                spans.append((index, at, at + len(value)))
                at += len(value)
            places.append(spans)
        a, b = places
        common = sorted({end for _, _, end in a} & {end for _, _, end in b})
        groups, low = [], 0
        for end in common:
            groups.append("|".join(",".join(str(index) for index, start, stop in side if low <= start and stop <= end) for side in places))
            low = end
        links, k = [], 0
        for index, start, stop in a:
            while k and b[k][1] > start:
                k -= 1
            while k < len(b) and b[k][2] <= start:
                k += 1
            j = k
            while j < len(b) and b[j][1] < stop:
                links.append((index, b[j][0]))
                j += 1
        return len(a), len(b), groups, links

    def corpus(self, rows):
        found = [(key, *self.aligned(text)) for key, text in rows]
        counts = Counter(pair for *_, links in found for pair in set(links))
        most = defaultdict(int)
        for (a, _), n in counts.items():
            most[a] = max(most[a], n)
        out = Counter()
        for key, n_a, n_b, groups, links in found:
            best = sum(counts[pair] == most[pair[0]] for pair in links)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
            out[key, n_a, n_b, len(groups), len(links), best, sum(counts[pair] for pair in links), digest] += 1
        return out


ALIGNED = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def long_text(seed, words):
    return "  ".join(sentence(seed + k, 40) + ("\n" if k % 3 else " ü日本 x") for k in range(words // 40))


@pytest.fixture(scope="module")
def brute():
    return Brute()


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(BYTES, PIECES)


@pytest.mark.parametrize("settings", [{}, {"range_bytes": 50}, {"range_bytes": 400, "broadcast_pairs": 40}, {"broadcast_pairs": 0}],
                         ids=["production", "many ranges", "rare pairs shuffled", "all pairs shuffled"])
def test_alignment_equals_brute_force(spark, brute, settings):
    rows = [(k, text) for k, text in enumerate(ODD)] + [(3, None), (None, sentence(5, 50)), (None, sentence(5, 50)), (3, sentence(6, 30))]
    rows += [(100 + k, long_text(k, 200)) for k in range(3)]
    docs = spark.createDataFrame([(key, text, "x", -1) for key, text in rows], "doc_id long, text string, codes string, row int")
    found = alignment.align(docs, BYTES, PIECES, **settings)
    assert Counter(tuple(r[name] for name in ALIGNED) for r in rows_of(found)) == brute.corpus(rows)


def test_alignment_of_the_documents(spark, small, brute):
    found = QUERIES["op11_fragment_monoid"](spark, small)
    assert Counter(tuple(r[name] for name in ALIGNED) for r in rows_of(found)) == brute.corpus(texts_of(spark, small).items())


def test_alignment_of_no_rows(spark, no_docs):
    assert rows_of(alignment.align(no_docs, BYTES, PIECES)) == []


def test_fragments_compose_in_any_grouping(aligner, brute):
    text = long_text(9, 120) + " " + "wordwithoutspaces" * 12 + " end"
    data = (" " + text).encode()
    parts = [
        aligner.range(data[begin:end], begin, low, high)
        for size in (37,) for low, high, begin, end in alignment.places_to_cut(data, size)
    ]
    assert len(parts) > 20 and any(len(part.suffix[0][0]) or len(part.suffix[1][0]) for part in parts)

    def folded(order):
        left = list(parts)
        while len(left) > 1:
            k = order(len(left) - 1)
            left[k:k + 2] = [aligner.compose(left[k], left[k + 1])]
        return aligner.compose(alignment.Fragment(cut=True), left[0]).closed

    draw = random.Random(4)
    expected = aligner.text(text)
    n_a, n_b, groups, links = brute.aligned(text)
    assert (expected.n_a, expected.n_b, expected.text) == (n_a, n_b, ";".join(groups))
    assert Counter(np.frombuffer(expected.codes, aligner.code_type).tolist()) == Counter(a * aligner.b_ids + b for a, b in links)
    for order in (lambda n: 0, lambda n: n - 1, draw.randrange, draw.randrange):
        assert folded(order) == expected
    neutral = aligner.compose(aligner.compose(alignment.Fragment(), parts[3]), alignment.Fragment())
    assert alignment.as_row(0, 0, 0, neutral) == alignment.as_row(0, 0, 0, parts[3])


# Periodic runs

def brute_runs(words):
    found = []
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at + period < len(words):
            start = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            length = at - start + period
            if at > start and length >= max(6, 4 * period):
                own = words[start:start + length]
                if not any(own[q:] == own[:-q] for q in range(1, period)):
                    found.append((start, length, period))
            at = max(at, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def brute_report(key, text):
    words = (text or "").encode().split()
    if key is not None and words:
        code = zlib.crc32(str(key).encode())
        turn = code // 10
        if code % 10 == 0:
            at = turn % len(words)
            period = 1 + (len(words) - at) // (3 + turn % 8)
            words = [word if k < at else words[at + (k - at) % period] for k, word in enumerate(words)]
    runs = brute_runs(words)
    gone = {k for start, length, period in runs for k in range(start + period, start + length)}
    best = max(runs, key=lambda run: (run[1] / run[2], -run[0], -run[2]), default=(None, None, None))
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
    kept = b" ".join(word for k, word in enumerate(words) if k not in gone)
    return key, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def test_runs_equal_brute_force():
    draw, texts = random.Random(1), [[]]
    for _ in range(600):
        words = [b"%d" % draw.randrange(draw.choice([1, 2, 3, 30])) for _ in range(draw.randrange(60))]
        if words and draw.random() < 0.6:
            at = draw.randrange(len(words))
            period = 1 + (len(words) - at) // draw.randrange(3, 11)
            words = [word if k < at else words[at + (k - at) % period] for k, word in enumerate(words)]
        texts.append(words)
    found = periodic_runs.text_runs(texts)
    assert found == [brute_runs(words) for words in texts] and sum(map(len, found)) > 200
    assert periodic_runs.text_runs([[b"a"] * 300_000, [b"a", b"b", b"c"] * 5]) == [[(0, 300_000, 1)], [(0, 15, 3)]]


REPORT = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_of_every_document(spark, gate):
    found = Counter(tuple(r[name] for name in REPORT) for r in rows_of(QUERIES["op12_periodic_runs"](spark, gate)))
    assert found == Counter(brute_report(key, text) for key, text in texts_of(spark, gate).items())


def test_runs_of_odd_rows(docs, no_docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = Counter(tuple(r[name] for name in REPORT) for r in rows_of(QUERIES["op12_periodic_runs"](docs.sparkSession, str(tmp_path))))
    assert found == Counter(brute_report(key, text) for key, text, *_ in ROWS)
    assert rows_of(periodic_runs.find_runs(no_docs)) == []


# Token tables

@pytest.mark.parametrize("n", [0, 1, 7, id_coder.BLOCK_IDS, id_coder.BLOCK_IDS + 1, 5000])
def test_blocks_return_their_ids(n):
    draw = np.random.default_rng(n)
    for ids in (draw.integers(0, 50257, n), np.zeros(n), draw.zipf(1.2, n) % 50257, np.arange(n) % 13, np.full(n, 50256)):
        ids = ids.astype(np.uint32)
        blocks = id_coder.encode(ids, 50257)
        assert len(blocks) == -(-n // id_coder.BLOCK_IDS)
        assert [k for block in id_coder.decode(blocks[::-1], 50257)[::-1] for k in block.tolist()] == ids.tolist()


def test_carries_run_through_full_words():
    """A state about to overflow behind words of all ones."""
    out = id_coder.Writer(2, 4)
    out.words[:, :3], out.used[:] = [[5, 0xFFFFFFFF, 0xFFFFFFFF], [7, 1, 2]], 3
    out.low[:], out.range[:] = np.uint64(0xFFFFFFFFFFFFFF00), np.uint64(1 << 40)
    out.narrow(slice(0, 2), np.array([9, 0]), np.array([1, 1]), 16)
    assert out.words[0, :3].tolist() == [6, 0, 0] and out.words[1, :3].tolist() == [7, 1, 2]


def test_frequent_ids_take_few_bits_and_damage_is_noticed():
    words = np.random.default_rng(0).zipf(1.5, 20_000).astype(np.uint32) % 500
    blocks = id_coder.encode(np.tile(words[:200], 100), 50257)
    assert sum(map(len, blocks)) < 20_000
    blocks = id_coder.encode(words, 50257)
    for damaged in (blocks[0][:-1], b"none" + blocks[0][4:], blocks[0][:40] + bytes([blocks[0][40] ^ 1]) + blocks[0][41:], b""):
        with pytest.raises(id_coder.Damaged):
            id_coder.decode([blocks[1], damaged], 50257)


def test_word_ids_equal_the_whole_tokenizer():
    tokenizer, words = Tokenizer.from_file(BYTES), ByteTokens(BYTES)
    for text in [*ODD, sentence(3, 80), long_text(2, 200)]:
        assert np.frombuffer(words.of(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert "".join(spaced_words(text)) == text


def expected_tables(rows):
    """(doc_id, n_tokens, crc) in order, and the set of starts for each id."""
    tokenizer = Tokenizer.from_file(BYTES)
    out = []
    for key, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((key, len(ids), zlib.crc32(ids.tobytes())))
    return out


def test_token_table_of_the_documents(spark, gate):
    rows = sorted(texts_of(spark, gate).items())
    found = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows_of(QUERIES["op13_range_coded_ids"](spark, gate)))
    start, expected = 0, []
    for key, n, crc in expected_tables(rows):
        expected.append((key, start, n, crc))
        start += n
    assert found == expected


def test_token_table_of_odd_rows(spark, docs, no_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "LANES", 2)
    path = f"{tmp_path}/table"
    token_files.write_token_table(docs, path, BYTES)
    found = rows_of(token_files.read_token_table(spark, path, 50257))
    assert Counter((r["doc_id"], len(r["ids"]) // 4, zlib.crc32(r["ids"])) for r in found) == Counter(expected_tables((key, text) for key, text, *_ in ROWS))
    found.sort(key=lambda r: r["start"])
    assert [r["start"] for r in found] == np.cumsum([0, *(len(r["ids"]) // 4 for r in found[:-1])]).tolist()
    keys = [r["doc_id"] for r in found]
    assert keys == sorted(keys, key=lambda key: (key is not None, key or 0))
    token_files.write_token_table(no_docs, f"{tmp_path}/none", BYTES)
    assert rows_of(token_files.read_token_table(spark, f"{tmp_path}/none", 50257)) == []


def test_a_table_without_one_of_its_blocks_is_refused(spark, docs, tmp_path):
    path = f"{tmp_path}/table"
    token_files.write_token_table(docs.repartition(1), path, BYTES)
    blocks = spark.read.parquet(path)
    largest = blocks.groupBy("part").count().orderBy("count", ascending=False).first()["part"]
    blocks.where(f"part <> {largest} OR block <> 1").write.parquet(f"{tmp_path}/less")
    with pytest.raises(Exception, match="lacks block"):
        token_files.read_token_table(spark, f"{tmp_path}/less", 50257).collect()
