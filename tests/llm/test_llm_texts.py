"""Operators on single texts against brute force, plain definitions and held-out labels."""

from __future__ import annotations

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidefare.llm import ftrl_toxicity, html_blocks, lz_fingerprint, packing, ppm_language, repetition
from tidefare.llm.common import RunHashes
from tidefare.llm.queries import QUERIES

from .conftest import ROWS, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def rows_of(frame):
    return [row.asDict() for row in frame.collect()]


# Phrase fingerprints

def naive_phrases(text):
    known, start = set(), 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in known:
            known.add(text[start:end])
            start = end
    return known


@pytest.mark.parametrize("text", ["", "a", "aa", "aaaaaaaaaaaa", "abababababab", sentence(3, 60), "東京東京 ü" * 9])
def test_parse_gives_the_phrases_of_the_definition(text):
    known = set()
    ends = []
    lz_fingerprint.parse(text, 0, known, ends)
    assert known == naive_phrases(text)
    starts = [0, *ends[:-1]]
    assert {text[a:b] for a, b in zip(starts, ends)} == known


def test_an_edit_shares_the_parse_of_what_it_keeps():
    walker = lz_fingerprint.Walker()
    one, other = sentence(4, 90), sentence(5, 70)
    signature, edited, edited_signature = walker.with_edit(one, other)
    assert edited == one[:len(one) - len(one) // 2] + other[:len(one) // 2]
    assert (signature == walker.whole(one)).all() and (edited_signature == walker.whole(edited)).all()


def test_fingerprints_of_every_row(spark, docs, no_docs):
    found = rows_of(lz_fingerprint.fingerprints(docs))
    ordered = sorted(((key, text or "") for key, text, *_ in ROWS), key=lambda row: (row[0] is not None, row[0] or 0, row[1]))
    expected = []
    for k, (key, text) in enumerate(ordered):
        half = len(text) // 2
        edited = text[:len(text) - half] + ordered[(k + 1) % len(ordered)][1][:half]
        expected.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == Counter(expected)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] and by_id[7]["fingerprint"] == "" == by_id[6]["fingerprint"]
    assert by_id[6]["near_next"] == 1.0 and by_id[1]["near_next"] == 1.0 and 0.2 < by_id[12]["near_edited"] < 0.9
    assert rows_of(lz_fingerprint.fingerprints(no_docs)) == []
    alone = rows_of(lz_fingerprint.fingerprints(spark.createDataFrame([(5, "abc abd abe")], "doc_id long, text string")))
    assert alone[0]["near_next"] == 1.0


# Language

def test_code_lengths_follow_the_definition(spark):
    rows = [("abracadabra", "x"), ("abrakadabra", "x"), ("banana", "y")]
    counted = ppm_language.context_counts(spark.createDataFrame(rows, "text string, lang string"), 2).toPandas()
    names = ["x", "y"]
    model = ppm_language.build_model(
        names, counted["gram"].to_numpy(np.int64), counted["lang"].map({"x": 0, "y": 1}).to_numpy(np.int64), counted["n"].to_numpy(np.int64), 2, least_seen=1
    )
    counts = {name: Counter() for name in names}
    for text, name in rows:
        data = b"\n\n" + text.encode()
        for k in range(2, len(data)):
            for depth in range(3):
                counts[name][data[k - depth:k], data[k]] += 1

    def bits(text, name):
        data, total = b"\n\n" + text, 0.0
        for k in range(2, len(data)):
            for depth in (2, 1, 0):
                seen = {b: n for (context, b), n in counts[name].items() if context == data[k - depth:k] and len(context) == depth}
                if not seen:
                    continue
                n, q = sum(seen.values()), len(seen)
                if data[k] in seen:
                    total -= np.log2(seen[data[k]] / (n + q))
                    break
                total -= np.log2(q / (n + q))
            else:
                total += 8
        return total

    for text in (b"abra", b"banana", b"zebra", b"", b"a\nb"):
        assert np.allclose(model.bits([text])[0], [bits(text, name) for name in names], rtol=1e-5)
    together = model.bits([b"abra", b"", b"zebra"])
    assert np.allclose(together[2], model.bits([b"zebra"])[0]) and together[1].tolist() == [0, 0]


def test_the_driver_holds_little_more_than_the_language_model():
    random = np.random.default_rng(5)
    runs = np.unique(random.integers(97, 123, (60_000, 5)) % [256, 256, 256, 256, 4], axis=0)
    grams, language = sum(runs[:, k].astype(np.int64) << (8 * k) for k in range(4)), runs[:, 4].astype(np.int64)
    tracemalloc.start()
    model = ppm_language.build_model(list("abcd"), grams, language, np.full(len(grams), 4), least_seen=1)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    held = model.costs.nbytes + sum(step.nbytes for step in model.steps)
    assert len(model.costs) > 10_000 * 27 and peak < 2 * held


def test_language_on_held_out_documents(spark, gate):
    found = QUERIES["op2_ppm_language"](spark, gate).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{gate}/documents.parquet").toPandas().set_index("doc_id")
    assert len(found) == len(docs)
    held = found[found["held_out"]]
    assert all((zlib.crc32(str(key).encode()) % 3 == 1) == flag for key, flag in found["held_out"].items())
    assert (held["lang_pred"] == docs["lang"].loc[held.index]).mean() > 0.97
    assert found["score"].between(0, 1).all()


def test_language_of_odd_rows(docs, no_docs):
    model = ppm_language.fit(docs)
    found = {r["doc_id"]: r for r in rows_of(ppm_language.predict(docs, model))}
    assert ppm_language.predict(docs, model).count() == len(ROWS)
    assert {key for key, r in found.items() if r["lang_pred"] == "und"} == {6, 7, 8, 15}
    kept = ppm_language.keep_known(docs, model)
    assert kept.columns == docs.columns and {6, 7, 8, 15}.isdisjoint({r["doc_id"] for r in rows_of(kept)})
    assert {1, 2, 3, 4, 5, 10, 11, 12}.issubset({r["doc_id"] for r in rows_of(kept)})
    nothing = ppm_language.fit(no_docs)
    assert rows_of(ppm_language.predict(no_docs, nothing)) == []
    assert {r["lang_pred"] for r in rows_of(ppm_language.predict(docs, nothing))} == {"und"}


# Toxicity

def test_toxicity_on_held_out_documents(spark, gate):
    found = QUERIES["op3_ftrl_toxicity"](spark, gate).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{gate}/labels.parquet").toPandas().groupby("doc_id")["toxic"].max()
    held = found[found["held_out"]].join(labels, how="inner")
    toxic, clean = held[held["toxic"] == 1]["score"], held[held["toxic"] == 0]["score"]
    assert np.mean([(clean < score).mean() for score in toxic]) > 0.85
    assert (clean >= 0.5).mean() < 0.05
    assert ((found["score"] >= 0.5) == (found["predicted"] == 1)).all()


def test_toxicity_finds_pairs_and_handles_odd_rows(spark, docs, no_docs):
    texts = [(k, sentence(k, 30) + (" bad thing" if k % 2 else " bad") + " " + sentence(k + 500, 10)) for k in range(200)]
    train = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)] + [(3, None), (5, 0)], "doc_id long, toxic int")
    weights = ftrl_toxicity.fit(train, labels)
    assert 0 < len(weights) < 2000
    scored = {r["doc_id"]: r["score"] for r in rows_of(ftrl_toxicity.score(train, weights))}
    assert np.mean([scored[k] for k in range(1, 200, 2)]) > 0.6 > 0.4 > np.mean([scored[k] for k in range(0, 200, 2)])
    assert len(rows_of(ftrl_toxicity.score(docs, weights))) == len(ROWS)
    assert rows_of(ftrl_toxicity.score(no_docs, weights)) == []
    unlabelled = ftrl_toxicity.fit(docs, labels.limit(0))
    assert {r["predicted"] for r in rows_of(ftrl_toxicity.score(docs, unlabelled))} == {0}


def plain_ftrl(examples, size, epochs):
    """The published update rule, one coordinate at a time in dictionaries."""
    alpha, beta, l1, l2 = ftrl_toxicity.ALPHA, ftrl_toxicity.BETA, ftrl_toxicity.L1, ftrl_toxicity.L2
    z, n, order = Counter(), Counter(), np.random.default_rng(0)
    positive = sum(label for _, label in examples)
    heavier = ((len(examples) - positive) / max(1, positive)) ** ftrl_toxicity.HEAVIER

    def weight(k):
        limit = 0.0 if k == size else l1
        if abs(z[k]) <= limit:
            return 0.0
        return -(z[k] - (limit if z[k] > 0 else -limit)) / ((beta + n[k] ** 0.5) / alpha + l2)

    for _ in range(epochs):
        for e in order.permutation(len(examples)):
            coordinates, label = examples[e]
            w = {k: weight(k) for k in coordinates}
            p = 1 / (1 + np.exp(-min(35.0, max(-35.0, sum(w.values())))))
            g = (p - label) * (heavier if label else 1.0)
            for k in coordinates:
                sigma = ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / alpha
                z[k] += g - sigma * w[k]
                n[k] += g * g
    return {k: weight(k) for k in z if weight(k)}


def test_updates_equal_the_plain_rule():
    runs, examples = RunHashes(), []
    for k in range(50):
        text = sentence(900 + k, 25) + (" very bad thing" if k % 4 == 0 else " very good thing")
        found = np.unique(ftrl_toxicity.occurrences(ftrl_toxicity.plain_words([text.encode()], runs).of(0), 12))
        examples.append((np.append(found, 1 << 12), int(k % 4 == 0)))
    found = ftrl_toxicity.train(examples, 12, epochs=12)
    expected = plain_ftrl([(at.tolist(), label) for at, label in examples], 1 << 12, 12)
    assert found.keys() == expected.keys() and len(found) > 3
    assert all(found[k] == pytest.approx(expected[k], rel=1e-9) for k in found)


def test_coordinates_of_words_pairs_and_skipping_pairs():
    runs = RunHashes()

    def of(text):
        return Counter(ftrl_toxicity.occurrences(ftrl_toxicity.plain_words([text.encode()], runs).of(0)).tolist())

    assert [sum(of(text).values()) for text in ("", "a", "a b", "a b c", "a b c d")] == [0, 1, 3, 6, 9]
    one, two, pair = of("a"), of("b"), of("a b")
    neighbours = pair - one - two
    assert sum(neighbours.values()) == 1 and of("b a") - one - two != neighbours  # order counts
    assert of("A, b!") == pair
    skipping = of("a x b") - of("x") - (of("a x") - of("x")) - (of("x b") - of("x"))
    assert sum(skipping.values()) == 1 and not skipping & neighbours and not skipping - of("a y b")


# Pages

def test_main_text_of_an_article():
    page = (
        '<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li><a href=1>One</a>'
        '<li><a href=2>Two</a></ul></nav><div class="ad">Buy this now</div><article><h1>Head &amp; tail</h1><p><b>First   part<br>of a text\n here.'
        '<p>Caf&eacute; &#8212; it&amp;s <a href="x>y">linked</a> a little, in a longer line of words.</p></article><!-- gone -->'
        '<div id="comments"><p>I liked this very much, thank you for writing it all down.</p></div><footer>&copy; us</footer>'
    )
    text, blocks = html_blocks.main_text(page, html_blocks.trained_tree())
    assert text == "Head & tail\nFirst part of a text here.\nCafé — it&s linked a little, in a longer line of words."
    assert blocks == 9


LINE = "words of a longer line that stands in the article and is read to its end"


@pytest.mark.parametrize("part, text", [
    ('<svg viewBox="0 0 1 1"/>', ""),
    ("<math/>", ""),
    ("<svg><title/><style/><path d=1 /><text>No</text></svg>", ""),
    ("<svg><foreignObject><div>No</div></foreignObject></svg>", ""),
    ("<datalist><option>No<option>No</datalist>", None),
    ("<span><option>No</span>", ""),
    ("<select><option>No<option>No</select>", ""),
    ("<object><p>No</p><h2>No</h2></object>", ""),
    ("<iframe src=x />", ""),
    ("<script>No</script><noscript>No <b>no</b></noscript>", ""),
    ("<a href=x><svg><a>No</a></svg></a>", ""),
    ("<math><mrow><mi>x</mi><mo>+</mo><mn>1</mn></mrow></math>", "x+1"),
    ("<math><mtable><mtr><mtd>1</mtd><mtd>2</mtd></mtr></mtable>", "1 2"),
])
def test_elements_without_text_end_where_html_ends_them(part, text):
    page = f"<article><h1>Head</h1><p>First {LINE} {part} second {LINE}</p><p>Third {LINE}</p></article><footer>us</footer>"
    found = [block.text for block in html_blocks.blocks(page)]
    assert "No" not in " ".join(found).split()
    if text is not None:
        assert found == ["Head", " ".join(f"First {LINE} {text} second {LINE}".split()), f"Third {LINE}", "us"]
        assert html_blocks.main_text(page, html_blocks.trained_tree())[0] == "\n".join(found[:3])
    else:
        assert found == ["Head", f"First {LINE}", f"second {LINE}", f"Third {LINE}", "us"]


def test_an_open_drawing_ends_at_the_next_paragraph():
    found = html_blocks.blocks(f"<div><svg><path d=1><p>First {LINE}</p></div><div><canvas>No</div><p>Second {LINE}</p>")
    assert [block.text for block in found] == [f"First {LINE}", f"Second {LINE}"]


BODY = f"<h1>Head of it</h1><p>First {LINE}, and a little more of it.</p><p>Second {LINE}, and a little more.</p>"


@pytest.mark.parametrize("page", [
    f"<form id=aspnetForm><div>{BODY}</div></form>",
    f"<form><fieldset><article>{BODY}</article></fieldset></form>",
    f"<form><main>{BODY}</main></form>",
    f"<nav><ul><li><a href=1>One</a><main>{BODY}</main>",
    f"<head><title>T</title><body>{BODY}",
    f"<html class=no-banner><body class='menu-open has-sidebar'>{BODY}</body></html>",
    f"<div class='layout with-footer'>{BODY}</div>",
    f"<div class='menu-open'><div id=sidebar-layout>{BODY}</div><div class=comments>{LINE}</div></div>",
    f"<article><h1>Head of it</h1><div class=has-sidebar>{BODY[19:]}</div><div class=comments>{BODY}{BODY}</div></article>",
    f"<article><h1>Head of it</h1><div class=social-box>{BODY[19:]}</div></article>",
    f"<div class=sidebar-left><article>{BODY}</article></div>",
])
def test_frames_of_the_text_are_no_furniture(page):
    text = html_blocks.main_text(f"{page}<footer>All rights are with us</footer>", html_blocks.trained_tree())[0]
    assert text.split("\n") == ["Head of it", f"First {LINE}, and a little more of it.", f"Second {LINE}, and a little more."]


@pytest.mark.parametrize("furniture", [
    f"<div class=comments>{BODY * 3}</div>",
    f"<form>{BODY * 3}</form>",
    f"<aside><article>{BODY}</article></aside>",
    f"<div hidden><main>{BODY}</main></div>",
    f"<article class=comment><article>{BODY}</article></article>",
])
def test_furniture_beside_an_article_stays_furniture(furniture):
    page = f"<article><p>First {LINE}</p>%s</article>%s"
    for inside, after in ((furniture, ""), ("", furniture)):
        assert html_blocks.main_text(page % (inside, after), html_blocks.trained_tree())[0] == f"First {LINE}"


@pytest.mark.parametrize("page, text", [
    (f'<article><p data-caption="<b>Leak</b> of it">First {LINE}</p><img alt="x <i>y</i> z"><p title=\'a > "b" <p>\'>Second {LINE}</p></article>', [f"First {LINE}", f"Second {LINE}"]),
    (f"<article><p class=it's>First {LINE} isn't</p><p title=\"open>Second {LINE}</p></article>", [f"First {LINE} isn't", f"Second {LINE}"]),
    (f"<article class='post format-aside tag-social'><p>First {LINE}</p></article><article class=post><p>Second {LINE}</p></article>", [f"First {LINE}", f"Second {LINE}"]),
    (f"<article><p>First {LINE}</p><ul><li><a href=1>One source</a><li><a href=2>Another one</a></ul><p><a href=3>{LINE}</a></p></article>",
     [f"First {LINE}", "One source", "Another one", LINE]),
    (f"<article><p>First {LINE}</p></article><div id=userComments><p>{LINE}</p></div><div class=readerResponses><p>{LINE}</p><div><p>{LINE}</p></div></div>", [f"First {LINE}"]),
    (f"<article><p>First {LINE}</p></article><article class='related'><p>{LINE}</p></article><article class='comment-body depth-1'><p>{LINE}</p></article>", [f"First {LINE}"]),
])
def test_articles_keep_their_text_and_nothing_leaks(page, text):
    found = html_blocks.main_text(f"<nav><a href=1>Home</a></nav>{page}<footer>All rights are with us</footer>", html_blocks.trained_tree())[0]
    assert found.split("\n") == text


def test_pages_with_clashing_columns(spark):
    rows = [(1, "u", f"<article><p>First {LINE}</p></article>", "x", 7, "y"), (1, "u", None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int, n_blocks string")
    found = Counter((r["page_id"], r["text"], r["n_chars"]) for r in rows_of(html_blocks.extract(pages)))
    assert found == Counter([(1, f"First {LINE}", len(LINE) + 6), (1, "", 0)])


def test_every_page_gives_its_article(spark, gate):
    import html

    pages = spark.read.parquet(f"{gate}/pages.parquet").toPandas()
    found = QUERIES["op5_block_tree"](spark, gate).toPandas().set_index("page_id")
    assert len(found) == len(pages) and (found["text"].str.len() == found["n_chars"]).all()
    for page in pages.itertuples():
        body = page.html[page.html.index("<article>"):page.html.index("</article>")]
        parts = (" ".join(html.unescape(re.sub(r"</?b>|<br>", "", part)).split()) for part in re.split(r"<article>|</?(?:p|h1)>", body))
        assert found["text"][page.page_id] == "\n".join(part for part in parts if part)


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text without any markup at all, but quite a few words in it to read"), (4, "u", "<p"), (5, "u", "<script>x"),
            (6, "u", "<!-- open"), (6, "u", "<!-- open"), (None, "u", "<article><p>" + "word " * 40000 + "</article>"), (8, "u", '<p title="a' * 3000)]
    found = rows_of(html_blocks.extract(spark.createDataFrame(rows, "page_id long, url string, html string")))
    assert len(found) == len(rows)
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts[1] == texts[2] == texts[4] == texts[5] == texts[6] == "" and texts[3].startswith("plain") and len(texts[None].split()) == 40000


# Packing

def test_pieces_rebuild_the_token_ids(docs, no_docs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    found = packing.pack_documents(docs, TOKENIZER, capacity=256, chunk_tokens=3000).toPandas()
    for key, text, *_ in ROWS:
        if key == 2 or key is None:
            continue
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        own = found[found["doc_id"] == key].sort_values("start")
        assert own["length"].sum() == len(ids) // 4 == own["doc_tokens"].iloc[0]
        assert [zlib.crc32(ids[4 * s:4 * (s + n)]) for s, n in zip(own["start"], own["length"])] == own["ids_crc32"].tolist()
        assert (own["start"] == own["length"].cumsum() - own["length"]).all()
    for _, sequence in found.sort_values("offset").groupby("sequence_id"):
        assert (sequence["offset"] == sequence["length"].cumsum() - sequence["length"]).all() and sequence["length"].sum() <= 256
    assert found[found["doc_id"] == 2]["length"].sum() == 2 * found[found["doc_id"] == 1]["length"].sum()
    assert rows_of(packing.pack_documents(no_docs, TOKENIZER)) == []


def test_sequences_need_no_padding_and_share_the_cost():
    lengths = [1 + (k * 7919) % 3000 for k in range(2000)] + [20000, 4096, 1]
    pieces = packing.pack(lengths)
    total, cost = Counter(), Counter()
    for document, start, length, sequence, offset in pieces:
        assert offset == total[sequence]
        total[sequence] += length
        cost[sequence] += packing.cost(length)
    assert sum(total.values()) == sum(lengths)
    assert all(n == 4096 or n & (n - 1) == 0 for n in total.values())
    mixed = [cost[s] for s, n in total.items() if n == 4096 and cost[s] < packing.cost(4096)]
    assert np.std(mixed) / np.mean(mixed) < 0.3


def test_word_tokens_equal_the_whole_tokenizer():
    tokenizer, words = Tokenizer.from_file(TOKENIZER), packing.WordTokens(TOKENIZER)
    for text in ["It's we'll I'D", "ÄÖÜ straße ÿ µ ª½²", "á é", "\x85x\x1cy\xa0z", "ΑΣ ΟΔΟΣ", "!!?!a1b22", "ﬁ ﬀ", "", "don’t", "<|endoftext|>a", "İstanbul", "x" * 5000]:
        assert np.frombuffer(words.of(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


# Repetition

def brute_rules(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    covered = np.zeros(len(words), bool)
    for k in range(len(words) - 7):
        if windows[tuple(words[k:k + 8])] > 1:
            covered[k:k + 8] = True
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), int(covered.sum())


def longest_repeat(words):
    best = 0
    for i in range(len(words)):
        for j in range(i):
            k = 0
            while i + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
    return best if best >= 8 else 0


def test_measures_equal_brute_force():
    texts = [text or "" for _, text, *_ in ROWS if len(text or "") < 40000]
    texts += [sentence(7, 30) + " " + sentence(8, 25) + " " + sentence(7, 30), "a " * 40, " ".join(sentence(9, 12).split() * 5 + ["end"])]
    found = repetition.measured([text.encode() for text in texts], RunHashes())
    for text, row in zip(texts, found):
        assert row[:5] == brute_rules(text)
        if row[0] < 300:
            assert row[5] == longest_repeat(text.split())


def test_a_long_text_of_one_word_needs_memory_for_its_words_only():
    import tracemalloc

    text = b"again " * 1_000_000
    tracemalloc.start()
    row = repetition.measured([text], RunHashes())[0]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert row[0] == row[4] == 1_000_000 and row[5] == 999_999
    assert most < 300 * 1_000_000


def test_rules_of_every_document(spark, gate, docs, no_docs):
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{gate}/documents.parquet").collect()}
    found = rows_of(QUERIES["op7_suffix_repetition"](spark, gate))
    assert len(found) == len(texts)
    for r in found:
        words, chars, symbols, lines, repeated = brute_rules(texts[r["doc_id"]])
        failed = words < 20 or 100 * repeated > 30 * words
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (words, chars, symbols, lines, repeated, failed)
        assert not (failed and r["kept"]) and (failed or repeated or r["kept"])
    assert len(rows_of(repetition.repetition_rules(docs))) == len(ROWS) and rows_of(repetition.repetition_rules(no_docs)) == []
