"""Line deduplication by an exact set-similarity join, in DataFrame functions only.

The tokens of a line are its distinct words. A line is removed if an earlier line of the input, by
(document, line number), has a Jaccard similarity of at least `PERCENT` in 100 to it, whether or not that
earlier line is removed itself. Lines without a word are left alone.

1. Lines of equal text: all but the first go, found by one count of line hashes.
2. Of the rest, tokens are put in order of rarity (the count of their hash bucket over the whole
   corpus, then their hash). Two lines of n and m tokens can only be similar if they share a token among
   the first n - ceil(0.8 n) + 1 and m - ceil(0.8 m) + 1, so lines meet in the groups of those tokens.
   A pair is dropped there if its sizes differ too much, if the tokens that can still follow the shared
   one are too few (positional filter), or if bitmaps of their tokens differ in more bits than the two
   lines may differ in tokens. Each later line keeps all earlier lines of the group that pass; past the first
   `SHORT` of a group, where the first line or the line just before is close, only that one.
3. The closest partner is verified on the full sets. Later lines whose closest partner fails meet all
   their other partners, again verified on full sets; those with untried ones ask, in semi joins that verify full
   sets, whether there is any.

Null and empty texts have no lines; an empty table gives no rows. Null doc_ids come first. Different texts
under one doc_id (or under none) are documents of their own, in order of a hash of the text; equal rows are
copies of one document: a line is no duplicate of the same line number there.
The tables that are broadcast have at most `BROADCAST_ROWS` rows; beyond that they are shuffled.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidefare.llm.common import identified, joined, stored

PERCENT = 80
#: What separates words.
SPACES = " \t\x0b\x0c\r\n"
#: Hash buckets in which tokens are counted: a table of fixed size.
BUCKET_BITS = 16
BROADCAST_ROWS = 400_000
#: The first lines of a group are compared with all lines before them.
SHORT = 64


def pieces(line: str, line_ends: bool = False) -> Column:
    """Words of a column, with repetitions, and empty ones where spaces meet; `line_ends` says that it may hold line ends."""
    text = F.col(line)
    odd = reduce(lambda a, b: a | b, (text.contains(space) for space in "\t\x0b\x0c\r"))
    # `translate` looks at every character; line ends, which most texts have, need no more than `replace`.
    plain = F.replace(text, F.lit("\n"), F.lit(" ")) if line_ends else text
    return F.split(F.when(odd, F.translate(text, "\t\x0b\x0c\r\n", "     ")).otherwise(plain), " ")


def tokens(text: str) -> Column:
    """Words of a column, with repetitions."""
    return F.array_remove(pieces(text, line_ends=True), "")


def bucket(token_hash: Column) -> Column:
    return token_hash.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1)).cast("int")


def token_ranks(docs: DataFrame) -> Column:
    """An array with the rank of rarity, 0 to 255, of each hash bucket, from counts over all words."""
    counted = (
        docs.select(F.explode(tokens("text")).alias("token"))
        .groupBy(bucket(F.xxhash64("token")).alias("bucket")).count().collect()  # one row a bucket
    )
    ranks = [0] * (1 << BUCKET_BITS)
    for row in counted:
        ranks[row["bucket"]] = min(255, int(8 * math.log2(row["count"])))
    return F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<smallint>")


def token_keys(line: str, ranks: Column) -> Column:
    """The line's distinct tokens as numbers, rarest first: 8 bits of rank, 55 bits of hash."""
    def key(h: Column) -> Column:
        # Numbers that cannot be null are sorted without boxes.
        rank = F.coalesce(F.get(ranks, bucket(h)).cast("long"), F.lit(0).cast("long"))
        return F.shiftleft(rank, 55).bitwiseOR(F.shiftrightunsigned(h, 9))

    # What stands inside a `transform` is not compiled; empty words go afterwards, by their number.
    keys = F.transform(F.transform(pieces(line), lambda token: F.xxhash64(token)), key)
    return F.sort_array(F.array_distinct(F.array_remove(keys, key(F.xxhash64(F.lit(""))))))


def numbered_lines(docs: DataFrame) -> DataFrame:
    return docs.select("doc", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def has_word(line: str | Column) -> Column:
    return F.ltrim(F.col(line) if isinstance(line, str) else line, F.lit(SPACES)) != ""


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc, line_no) of lines whose text stands earlier."""
    place = F.struct("doc", "line_no")
    hashed = numbered_lines(docs).where(has_word("line")).select(
        "doc", "line_no", F.xxhash64("line").alias("one"), F.xxhash64(F.lit(1), F.col("line")).alias("other")
    )
    hashed = stored(hashed, "lines-hashed")
    firsts = hashed.groupBy("one", "other").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("one", "other", "first")
    return hashed.join(firsts, ["one", "other"]).where(place != F.col("first")).select("doc", "line_no").distinct()


def by_document(lines: DataFrame, name: str) -> DataFrame:
    return lines.groupBy("doc").agg(F.collect_set("line_no").alias(name))


def with_lists(docs: DataFrame, lists: DataFrame) -> DataFrame:
    return joined(docs, lists, "doc", BROADCAST_ROWS, "left")


def prefix_table(docs: DataFrame, ranks: Column, gone: DataFrame, percent: int) -> DataFrame:
    """(doc, line_no, n, bits, more_bits, prefix) of lines that are not yet gone."""
    left = with_lists(docs.select("doc", "text"), gone).select("doc", "gone", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    left = left.where(F.col("gone").isNull() | ~F.array_contains("gone", F.col("line_no"))).where(has_word("line"))
    n = F.size("keys")

    def bits(upper: int) -> Column:
        """Half of a bitmap of 128 places: each token flips one."""
        own = F.filter("keys", lambda key: key.bitwiseAND(F.lit(64)) == 64 * upper)
        return F.aggregate(
            own, F.lit(0).cast("long"),
            lambda seen, key: seen.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))),
        )

    length = (n - F.ceil(n * percent / 100) + 1).cast("int")
    return left.select("doc", "line_no", token_keys("line", ranks).alias("keys")).select(
        "doc", "line_no", n.alias("n"), bits(0).alias("bits"), bits(1).alias("more_bits"), F.slice("keys", F.lit(1), length).alias("prefix")
    )


def entries(lines: DataFrame) -> DataFrame:
    return lines.select("doc", "line_no", "n", "bits", "more_bits", F.posexplode("prefix").alias("position", "token"))


def distance(one: str, other: str) -> Column:
    return reduce(Column.__add__, (F.bit_count(F.col(f"{one}.{name}").bitwiseXOR(F.col(f"{other}.{name}"))) for name in ("bits", "more_bits")))


def may_match(later: str, earlier: str, percent: int) -> Column:
    """Length, positional and bitmap filters for entries of one token."""
    a, b = (lambda name: F.col(f"{later}.{name}")), (lambda name: F.col(f"{earlier}.{name}"))
    both = a("n") + b("n")
    shared = F.least(a("n") - a("position"), b("n") - b("position")) + F.least(a("position"), b("position"))
    return (
        (F.least(a("n"), b("n")) * 100 >= F.greatest(a("n"), b("n")) * percent)
        & (shared * (100 + percent) >= both * percent)
        & (distance(later, earlier) * (100 + percent) <= both * (100 - percent))
    )


ENTRY = ("doc", "line_no", "n", "bits", "more_bits", "position")


def before(earlier: str, later: str) -> Column:
    return (F.col(f"{earlier}.doc") < F.col(f"{later}.doc")) | (
        (F.col(f"{earlier}.doc") == F.col(f"{later}.doc")) & (F.col(f"{earlier}.line_no") < F.col(f"{later}.line_no"))
    )


def partner(later: str, earlier: str) -> list[Column]:
    return [
        F.col(f"{later}.doc").alias("doc"), F.col(f"{later}.line_no").alias("line_no"),
        F.struct(distance(later, earlier).alias("distance"), F.col(f"{earlier}.doc").alias("doc"), F.col(f"{earlier}.line_no").alias("line_no")).alias("partner"),
    ]


def partners(lines: DataFrame, percent: int) -> DataFrame:
    """(doc, line_no, partners, untried): for each line that has partners, the earlier lines that pass the filters.

    Past the first `SHORT` lines of a group a line that is close to the group's first line, or to the
    line before it, is not compared with the others there; `untried` says so.
    """
    group = Window.partitionBy("token").orderBy("doc", "line_no")
    own = F.struct(*ENTRY)
    # Dealt once: the window and both sides of the join read the same shuffle.
    all_entries = entries(lines).select("token", *ENTRY).repartition("token")
    seen = all_entries.select(
        "token", own.alias("own"), F.row_number().over(group).alias("rank"),
        F.first(own).over(group.rowsBetween(Window.unboundedPreceding, 0)).alias("first"), F.lag(own).over(group).alias("last"),
    )
    near = F.when(F.col("rank") > SHORT, F.when(before("first", "own") & may_match("own", "first", percent), F.col("first")).when(
        before("last", "own") & may_match("own", "last", percent), F.col("last")
    ))
    chosen = seen.select("token", "own", near.alias("near"))
    others = all_entries.select("token", own.alias("other"))
    tried = F.when(F.col("near").isNotNull(), (F.col("other.doc") == F.col("near.doc")) & (F.col("other.line_no") == F.col("near.line_no"))).otherwise(
        before("other", "own") & may_match("own", "other", percent)
    )
    met = chosen.join(others, "token").where(tried).select(*partner("own", "other"), F.col("near").isNotNull().alias("untried"))
    return met.groupBy("doc", "line_no").agg(F.collect_set("partner").alias("partners"), F.max("untried").alias("untried"))


def line_keys(docs: DataFrame, ranks: Column, lines: DataFrame) -> DataFrame:
    """(doc, line_no, keys): the full sets of the given lines, each of which is given once."""
    wanted = stored(by_document(lines, "wanted"), "lines-wanted")
    some = joined(docs.select("doc", "text"), wanted, "doc", BROADCAST_ROWS)
    listed = some.select("doc", "wanted", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(F.array_contains("wanted", F.col("line_no")))
    return stored(listed.select("doc", "line_no", token_keys("line", ranks).alias("keys")), "lines-keys")


def similar(percent: int) -> Column:
    """Whether the full sets `own_keys` and `keys` are similar enough."""
    shared = F.size(F.array_intersect("own_keys", "keys"))
    return shared * 100 >= (F.size("own_keys") + F.size("keys") - shared) * percent


def verified(docs: DataFrame, ranks: Column, pairs: DataFrame, percent: int) -> DataFrame:
    """(doc, line_no) of those pairs (doc, line_no, partner) whose full sets are similar enough."""
    sides = [pairs.select("doc", "line_no"), pairs.select(F.col("partner.doc").alias("doc"), F.col("partner.line_no").alias("line_no"))]
    keyed = line_keys(docs, ranks, sides[0].unionByName(sides[1]).distinct())
    later = pairs.join(keyed, ["doc", "line_no"]).select("doc", "line_no", "partner", F.col("keys").alias("own_keys"))
    both = later.join(keyed.select(F.struct("doc", "line_no").alias("at"), "keys"), F.struct("partner.doc", "partner.line_no") == F.col("at"))
    return both.where(similar(percent)).select("doc", "line_no").distinct()


def untried_matches(docs: DataFrame, ranks: Column, lines: DataFrame, open_lines: DataFrame, percent: int) -> DataFrame:
    """(doc, line_no) of those of the given lines that are similar to any earlier line.

    All joins ask for one partner only, so their rows follow the entries, however many lines of a group are similar.
    Full sets travel only with entries that meet another.
    """
    theirs = stored(
        entries(joined(lines, open_lines.select("doc", "line_no"), ["doc", "line_no"], BROADCAST_ROWS, "left_semi")).select(F.col("token").alias("own_token"), F.struct(*ENTRY).alias("own")),
        "lines-untried",
    )
    meets = (F.col("token") == F.col("own_token")) & before("other", "own") & may_match("own", "other", percent)
    met = stored(joined(entries(lines).select("token", F.struct(*ENTRY).alias("other")), theirs, meets, BROADCAST_ROWS, "left_semi"), "lines-met")
    theirs = stored(joined(theirs, met, meets, BROADCAST_ROWS, "left_semi"), "lines-meeting")
    sides = [rows.select(f"{side}.doc", f"{side}.line_no") for rows, side in ((theirs, "own"), (met, "other"))]
    keyed = line_keys(docs, ranks, sides[0].unionByName(sides[1]).distinct())

    def with_keys(rows: DataFrame, side: str, name: str) -> DataFrame:
        return rows.join(keyed.select(F.struct("doc", "line_no").alias("at"), F.col("keys").alias(name)), F.struct(f"{side}.doc", f"{side}.line_no") == F.col("at")).drop("at")

    found = with_keys(theirs, "own", "own_keys").join(with_keys(met, "other", "keys"), meets & similar(percent), "left_semi")
    return found.select("own.doc", "own.line_no").distinct()


def removed_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc, gone): the numbers, from 0, of the lines to remove, from rows of (doc, text) as `identified` gives them."""
    repeated = stored(repeated_lines(docs), "lines-repeated")
    ranks = token_ranks(docs)
    lines = stored(prefix_table(docs, ranks, stored(by_document(repeated, "gone"), "lines-gone"), percent), "lines-prefixes")
    found = stored(partners(lines, percent), "lines-partners")
    closest = found.select("doc", "line_no", F.array_min("partners").alias("partner"))
    matched = stored(verified(docs, ranks, closest, percent), "lines-matched")
    left = stored(found.join(matched, ["doc", "line_no"], "left_anti"), "lines-open")
    others = left.select("doc", "line_no", F.explode("partners").alias("partner"), F.array_min("partners").alias("closest")).where("NOT untried AND partner <> closest").drop("closest")
    more = stored(verified(docs, ranks, others, percent), "lines-matched")
    last = stored(untried_matches(docs, ranks, lines, left.where("untried"), percent), "lines-matched")
    return stored(by_document(repeated.unionByName(matched).unionByName(more).unionByName(last), "gone"), "lines-gone")


def dedup_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, with all their columns, without the removed lines in `text`."""
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda line, k: ~F.array_contains("gone", k)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text")
    named = identified(docs, F.struct(*(F.col(f"`{name}`") for name in docs.columns)))
    rows = with_lists(named, removed_lines(named, percent))
    return rows.select(*(text if name == "text" else F.col(f"row.`{name}`") for name in docs.columns))


def dedup_report(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_lines with a word, n_removed and kept_sha256 of every document."""
    lines = F.coalesce(F.split("text", "\n"), F.array().cast("array<string>"))
    kept = F.filter(lines, lambda line, k: ~F.array_contains("gone", k))
    named = identified(docs)
    rows = with_lists(named, removed_lines(named, percent))
    return rows.select(
        "doc_id",
        F.size(F.filter(lines, has_word)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.sha2(F.when(F.col("gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n")), 256).alias("kept_sha256"),
    )
