"""Document fingerprints by SpotSigs.

A signature is a common word (the anchor) with the chain of the next ``CHAIN`` content words after it;
common words inside the chain are passed over. Common words are ``ANCHORS``; content words are all others.
A fingerprint is the ascending list of a text's distinct signature hashes. Two fingerprints are as like
as the Jaccard similarity of their sets.

Sets of m and n signatures can't be more alike than min(m, n) / max(m, n). So for a near-duplicate search
the documents are partitioned by set length, with bounds that make any two partitions but neighbours too
different, and a document looks only into its own and the neighbouring ones. There it meets only those with
which it shares a signature among its rarest (a prefix long enough that alike sets must share one), and a pair
is given up where length, prefix place and intersection can't reach the threshold any more. A signature in very
many prefixes is no meeting place by itself: such sets meet by pairs of signatures.

All of it is DataFrame operations. Words are lower-cased runs of letters, digits and underscores.

Defined cases: a null text is the empty text; a text without a signature has one for its whole sequence of
words, so that equal texts are alike and others aren't; a text of any length is read whole; equal rarity is
ordered by hash; rows with equal fingerprints are one class, named by its smallest id, null only where it has no
other; repeated rows are documents of their own in ``near_pairs`` and rows of their own in the query's result;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workpulse.llm.common import cut, shared_checkpoint_dir, text_or_empty
from workpulse.sources.versions import Folder

# Frequent function words of English, French, German and Spanish.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "have", "he", "in", "is", "it", "not",
    "of", "on", "or", "that", "the", "this", "to", "was", "were", "will", "with", "you",
    "au", "avec", "ce", "dans", "de", "des", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "ne", "par",
    "pas", "pour", "que", "qui", "sur", "un", "une",
    "auf", "das", "dem", "den", "der", "die", "ein", "eine", "für", "ich", "ist", "mit", "nicht", "sich", "sie",
    "und", "von", "zu",
    "al", "como", "con", "del", "el", "las", "lo", "los", "no", "para", "por", "se", "su", "una", "y",
)
CHAIN = 2
THRESHOLD = 0.8
#: Counts that order signatures by rarity.
BUCKETS = 1 << 14
#: Prefixes that may share a signature before pairs of signatures take its place.
HOT = 1000
#: Prefixes that may share a signature before their sets are told apart by their changes to a centre.
FAMILY = 32
#: Words of 64 bits of the table that tells which sets are in a pair.
ENDS = 1 << 18
#: Stands behind the last word; no text has it as a word.
_END = "\x01"
_NO_WORD = r"[^\p{L}\p{N}_]+"


def _let(value: Column, then) -> Column:
    """``then`` of a value that is worked out once, also where a lambda inside uses it many times."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The ascending array of a text's distinct signature hashes (32 bits)."""
    # the end mark is a content word: a chain must stop before it
    words = F.concat(F.trim(F.regexp_replace(F.lower(text), _NO_WORD, " ")), F.lit(f" {_END} "))

    def places(known: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(known) - 1), lambda i: ~F.get(known, i).isin(*ANCHORS))

    def of_words(known: Column) -> Column:
        def hashes(place: Column, i: Column) -> Column:
            before = F.coalesce(F.get(known["places"], i - 1), F.lit(-1))
            anchors = F.slice(known["words"], before + 2, place - before - 1)
            content = [F.get(known["words"], F.get(known["places"], i + k)) for k in range(chain)]
            whole = (place - before > 1) & F.get(known["places"], i + chain).isNotNull()
            return F.when(whole, F.transform(anchors, lambda anchor: F.hash(anchor, *content))).otherwise(F.array().cast("array<int>"))

        return F.array_distinct(F.flatten(F.transform(known["places"], hashes)))

    found = _let(F.split(F.trim(words), " "), lambda known: _let(F.struct(known.alias("words"), places(known).alias("places")), of_words))
    # without a signature: one for the sequence of words
    return _let(found, lambda known: F.when(F.size(known) > 0, F.array_sort(known)).otherwise(F.array(F.hash(words))))


def fingerprint_text(hashes: Column) -> Column:
    """A fingerprint as text: its hashes in hexadecimal, ascending, separated by spaces."""
    return F.lower(F.array_join(F.transform(hashes, lambda h: F.hex(h.cast("long").bitwiseAND(0xFFFFFFFF))), " "))


def pruned_jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two ascending sets; 0 without comparing where it can't reach ``least``.

    Sets whose sizes are too different can't reach it, and sets whose ranges don't meet share nothing.
    """
    fewer, more = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    apart = (F.element_at(a, -1) < F.element_at(b, 1)) | (F.element_at(b, -1) < F.element_at(a, 1))
    both = F.size(F.array_intersect(a, b))
    exact = both / (F.size(a) + F.size(b) - both)
    hopeless = (fewer == 0) | (fewer < least * more) | apart
    return F.when(hopeless, 0.0).when(exact >= least, exact).otherwise(0.0)


def length_partition(size: Column, threshold: float = THRESHOLD) -> Column:
    """Number of the partition of a set length; two lengths two partitions apart can't reach the threshold.

    Partition p has the lengths from threshold ** -p up to threshold ** -(p + 1).
    """
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(1.0 / threshold)) + 1e-9).cast("int")


def print_key(hashes: Column) -> Column:
    """A fingerprint's 64-bit name; sets with one name count as equal."""
    return F.xxhash64(hashes)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", chain: int = CHAIN) -> DataFrame:
    """(id, hashes, partition) of every row."""
    found = docs.select(docs[id_col].alias("id"), signatures(text_or_empty(docs[text]), chain).alias("hashes"))
    return found.withColumn("partition", length_partition(F.size("hashes")))


def _ordered(sets: DataFrame) -> DataFrame:
    """(print, size, ordered) of (print, hashes): the set as longs of rarity and hash, the rarest first.

    Rarity is the number of sets in a hash's bucket; the table of the ``BUCKETS`` counts has one size for any input.
    Any order that all sets share gives the same pairs; a good one keeps frequent signatures out of the prefixes.
    """
    bucket = F.pmod("hash", F.lit(BUCKETS))
    counted = sets.select(F.explode("hashes").alias("hash")).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    every = sets.sparkSession.range(BUCKETS).join(counted, F.col("id") == F.col("bucket"), "left")
    sketch = every.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("n", F.lit(0)).alias("n")))), lambda x: x["n"]).alias("n")
    )
    known = sets.select("print", F.size("hashes").alias("size"), F.struct("hashes", sketch.scalar().alias("n")).alias("known"))
    # one long for each: the rarity above the 32 bits of the hash
    ordered = _let(
        F.col("known"),
        lambda x: F.array_sort(
            F.transform(
                x["hashes"],
                lambda h: F.shiftleft(F.get(x["n"], F.pmod(h, F.lit(BUCKETS))).cast("long"), 32) + h.cast("long") + F.lit(1 << 31),
            )
        ),
    )
    return known.select("print", "size", ordered.alias("ordered"))


def _ends(found: DataFrame, words: int = ENDS) -> Callable[[Column], Column]:
    """Whether a print is an end of a pair (a, b): true for every end, and for a print that has an end's bit.

    The table of bits has one size for any input.
    """
    bits = F.lit(64 * words)
    place = F.pmod("end", bits)
    counted = (
        found.select(F.explode(F.array("a", "b")).alias("end"))
        .select((place / 64).cast("long").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("held"))
    )
    every = found.sparkSession.range(words).join(counted, F.col("id") == F.col("word"), "left")
    table = every.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("held", F.lit(0)).alias("held")))), lambda x: x["held"]).alias("held")
    ).scalar()

    def end(name: Column) -> Column:
        at = F.pmod(name, bits)
        return F.getbit(F.get(table, (at / 64).cast("int")), (at % 64).cast("int")) == 1

    return end


def _hashes_of(prints: DataFrame, names: DataFrame) -> DataFrame:
    """(print, hashes) of the prints among the ends (a, b) of ``names``, and of few others, each once.

    The others stay where they are: their hashes are most of the table.
    """
    return prints.where(_ends(names)(F.col("print"))).groupBy("print").agg(F.first("hashes").alias("hashes"))


def _families(
    shared: DataFrame, prefixes: DataFrame, prints: DataFrame, threshold: float, least: int, keep: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Sets like the centre of a family: (set, print, family, common, reach, changes); any other set has no row.

    Sets gather at the signature of their prefix that most prefixes share, if ``least`` do. Near copies share others there,
    too: signatures are dealt into four, and only where a quarter of the sets agree in the most shared one of each, the signatures
    that more than half of the sets have are a centre. It gives way to the largest one that it is like and that has its signature;
    sets without a centre at theirs go to the largest that has it. Any choice gives the same links, only by other ways.

    ``changes`` are the signatures that a set has and its centre of ``common`` signatures hasn't, or the other way round. With n
    signatures, of the centre all but r, two sets a, b of a family share common - r_a - r_b + (the changes that both have). So
    they are alike exactly where both have at least reach_a + reach_b - common changes in common, where ``reach`` is
    r + n * threshold / (1 + threshold).
    """
    # in one long, the number of prefixes above the 32 bits of the hash
    rank = F.shiftleft(F.col("n"), 32) + F.col("hash").cast("long") + F.lit(1 << 31)
    quarters = [f"most_{q}" for q in range(4)]
    top = F.greatest(*quarters)
    gathered = keep(
        shared.groupBy("set").agg(*(F.max(F.when(F.pmod("hash", F.lit(4)) == q, rank)).alias(c) for q, c in enumerate(quarters)))
        .where(F.shiftright(top, 32) >= least)
        .withColumn("key", (top.bitwiseAND(0xFFFFFFFF) - F.lit(1 << 31)).cast("int"))
        .join(prefixes.select("set", "print"), "set")
    )
    keys = (
        gathered.groupBy("key", *quarters).agg(F.count("*").alias("n"))
        .groupBy("key").agg(F.sum("n").alias("members"), F.max("n").alias("agree"))
    )

    def with_hashes(sets: DataFrame) -> DataFrame:
        return sets.join(_hashes_of(prints, sets.select(F.col("print").alias("a"), F.col("print").alias("b"))), "print")

    agreed = gathered.select("key", "print").join(keys.where(4 * F.col("agree") >= F.greatest("members", F.lit(least))), "key")
    centres = keep(
        with_hashes(agreed)
        .select("key", "members", F.explode("hashes").alias("hash")).groupBy("key", "members", "hash").agg(F.count("*").alias("held"))
        .where(2 * F.col("held") > F.col("members"))
        .groupBy("key", "members").agg(F.array_sort(F.collect_list("hash")).alias("centre"))
    )
    own = keys.select("key").join(centres.select("key", F.col("centre").alias("own")), "key", "left")
    others = centres.select(F.col("key").alias("family"), "members", "centre")
    chosen = keep(
        others.select("family", F.explode("centre").alias("key"))
        .join(own, "key").join(others, "family")
        .where(F.col("own").isNull() | (pruned_jaccard(F.col("own"), F.col("centre"), threshold) > 0))
        .groupBy("key").agg(F.max(F.struct("members", "family", "centre")).alias("best"))
        .select("key", "best.family", "best.centre")
    )
    # a set less like the centre can't be alike to one that the threshold holds to it
    near = with_hashes(gathered.select("set", "print", "key").join(chosen, "key"))
    near = near.where(pruned_jaccard(F.col("hashes"), F.col("centre"), 2 * threshold - 1) > 0)
    lost = F.array_except("centre", "hashes")
    return keep(
        near.select(
            "set", "print", "family", F.size("centre").alias("common"),
            (F.size(lost) + F.lit(threshold / (1 + threshold)) * F.size("hashes")).alias("reach"),
            F.concat(F.array_except("hashes", "centre"), lost).alias("changes"),
        )
    )


def _by_changes(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of a family that can be alike only by changes that both have; all that are alike are among them.

    Where a pair meets at its first common change, in the order that all share (those not in the centre come first), what
    follows must leave it enough in common; every alike pair does.
    """
    each = members.select("*", F.size("changes").alias("most"), F.posexplode("changes").alias("place", "change"))
    named = ("print", "reach", "most", "place")
    sides = [each.select("family", "change", "common", *(F.col(c).alias(f"{c}_{side}") for c in named)) for side in "ab"]
    need = F.col("reach_a") + F.col("reach_b") - F.col("common") - 1e-9
    can = F.least(F.col("most_a") - F.col("place_a"), F.col("most_b") - F.col("place_b"))
    return (
        sides[0].join(sides[1].drop("common"), ["family", "change"])
        .where((F.col("print_a") < F.col("print_b")) & (need > 0) & (can >= need))
        .select(F.col("print_a").alias("a"), F.col("print_b").alias("b"))
        .distinct()
    )


def _surely_alike(members: DataFrame) -> DataFrame:
    """(print, n): the number of other members of its family that a set is alike to whatever their changes.

    These are all whose reach leaves nothing to have in common: they are counted by reach, not met.
    """
    counted = members.groupBy("family", "common", "reach").agg(F.count("*").alias("n"))
    asked = counted.select(
        "family", "reach", (F.col("common") - F.col("reach") + 1e-9).alias("at"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("asks")
    )
    given = counted.select("family", "reach", F.col("reach").alias("at"), "n", F.lit(False).alias("asks"))
    up_to = Window.partitionBy("family").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = asked.unionByName(given).withColumn("all", F.sum("n").over(up_to)).where("asks").select("family", "reach", "all")
    itself = (2 * F.col("reach") - F.col("common") <= 1e-9).cast("long")
    return members.join(sums, ["family", "reach"]).select("print", (F.col("all") - itself).alias("n")).where("n > 0")


def _search(
    prints: DataFrame, threshold: float, hot: int, family: int, keep: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b) of prints that are in no family together, and the members of the families."""
    if not 0.5 < threshold <= 1:
        raise ValueError("the threshold must be above 0.5 and at most 1")
    own = F.col("size") - F.ceil(F.lit(threshold) * F.col("size") - 1e-9) + 1
    longer = F.transform(
        F.slice("ordered", F.lit(1), (own + 1).cast("int")), lambda x: (x.bitwiseAND(0xFFFFFFFF) - F.lit(1 << 31)).cast("int")
    )
    # copies become one before their signatures are dealt out
    prefixes = keep(
        _ordered(prints.select("print", "hashes"))
        .select("print", "size", longer.alias("longer"))
        .dropDuplicates(["print"])
        .withColumn("set", F.monotonically_increasing_id())
    )
    each = prefixes.select("set", "size", F.posexplode(F.slice("longer", F.lit(1), own.cast("int"))).alias("place", "hash"))
    counts = each.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    shared = keep(each.join(counts, "hash").withColumn("place", F.col("place") + 1))
    members = _families(shared, prefixes, prints, threshold, family, keep)
    shared = keep(shared.join(members.select("set", "family"), "set", "left"))
    light = _meet(shared.where(F.col("n") <= hot), ["hash"], 1, threshold)
    hot_sets = shared.where(F.col("n") > hot).groupBy("set", "family").agg(F.collect_set("hash").alias("hot"))
    # two signatures of a longer prefix, of which the first, in the order of all, is hot
    firsts = prefixes.join(hot_sets, "set").select("set", "family", "size", "longer", "hot", F.posexplode("longer").alias("i", "first"))
    two = keep(
        firsts.where(F.array_contains("hot", F.col("first")))
        .select("set", "family", "size", "i", "first", F.posexplode("longer").alias("j", "second"))
        .where("j > i")
        .select("set", "family", "size", "first", "second", (F.col("j") + 1).alias("place"))
    )
    found = light.unionByName(_meet(two, ["first", "second"], 2, threshold)).distinct()
    one, another = (prefixes.select(F.col("set").alias(f"set_{c}"), F.col("print").alias(c)) for c in "ab")
    found = found.join(one, "set_a").join(another, "set_b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return keep(found), members


def _compared(prints: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """(a, b, likeness) of the pairs that are alike."""
    named = _hashes_of(prints, found)
    left = named.select(F.col("print").alias("a"), F.col("hashes").alias("ha"))
    right = named.select(F.col("print").alias("b"), F.col("hashes").alias("hb"))
    likeness = pruned_jaccard(F.col("ha"), F.col("hb"), threshold - 1e-12)
    return found.join(left, "a").join(right, "b").select("a", "b", likeness.alias("likeness")).where("likeness > 0")


def near_classes(
    prints: DataFrame, threshold: float = THRESHOLD, hot: int = HOT, keep: Callable[[DataFrame], DataFrame] = cut, family: int = FAMILY
) -> DataFrame:
    """Near-duplicate search over (print, hashes): pairs (a, b, likeness) of unequal prints, each once, a < b.

    These are all pairs with a likeness of at least the threshold. Rows of equal print are one set. A signature that
    more than ``hot`` prefixes share is no key by itself: alike sets that share only such ones in their prefixes share
    two signatures in prefixes longer by one, so there they meet by pairs of signatures. Where ``family`` prefixes share a
    signature, sets that are like one centre are told apart by their changes to it. ``keep`` writes what is read more than once.
    """
    found, members = _search(prints, threshold, hot, family, keep)
    sides = [members.select("family", "common", *(F.col(c).alias(f"{c}_{side}") for c in ("print", "reach"))) for side in "ab"]
    sure = (
        sides[0].join(sides[1].drop("common"), "family")
        .where((F.col("print_a") < F.col("print_b")) & (F.col("reach_a") + F.col("reach_b") - F.col("common") <= 1e-9))
        .select(F.col("print_a").alias("a"), F.col("print_b").alias("b"))
    )
    return _compared(prints, keep(found.unionByName(sure).unionByName(_by_changes(members))), threshold)


def link_counts(
    prints: DataFrame, threshold: float = THRESHOLD, hot: int = HOT, keep: Callable[[DataFrame], DataFrame] = cut, family: int = FAMILY
) -> DataFrame:
    """(print, n_links): how many pairs of ``near_classes`` each print is in, where it is in any.

    The same search, but the pairs inside a family are made only where changes in common decide; all others are counted.
    """
    found, members = _search(prints, threshold, hot, family, keep)
    pairs = _compared(prints, keep(found.unionByName(_by_changes(members))), threshold)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("print"), F.lit(1).cast("long").alias("n"))
    return ends.unionByName(_surely_alike(members)).groupBy("print").agg(F.sum("n").alias("n_links"))


def _meet(keyed: DataFrame, keys: list[str], shared: int, threshold: float) -> DataFrame:
    """Pairs (set_a < set_b) of sets with a key in common, in one partition or in neighbours, that can be alike.

    ``place`` is that of the ``shared``-th common signature where the key is the first that they have in common;
    every alike pair has such a key, so rows whose places leave too few signatures are given up at once. Sets of one family
    don't meet: at a key families meet first, and only then their members.
    """
    home = length_partition(F.col("size"), threshold).alias("home")

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(*keys, *(F.col(c).alias(f"{c}_{name}") for c in ("set", "family", "size", "place")), home.alias(f"home_{name}"))

    sizes = F.col("size_a"), F.col("size_b")
    need = F.lit(threshold / (1 + threshold)) * (sizes[0] + sizes[1]) - 1e-9
    most = shared + F.least(sizes[0] - F.col("place_a"), sizes[1] - F.col("place_b"))
    can = (
        (F.abs(F.col("home_a") - F.col("home_b")) <= 1) & (most >= need)
        & (F.least(*sizes) >= F.lit(threshold) * F.greatest(*sizes) - 1e-9)
    )
    alone, together = keyed.where("family is null"), keyed.where("family is not null")
    by_set = side(alone, "a").join(side(keyed, "b"), keys).where((F.col("family_b").isNotNull() | (F.col("set_a") < F.col("set_b"))) & can)
    heads = together.select(*keys, "family").distinct()
    one, another = (heads.withColumnRenamed("family", f"family_{name}") for name in "ab")
    by_family = (
        one.join(another, keys).where("family_a < family_b")
        .join(side(together, "a"), [*keys, "family_a"])
        .join(side(together, "b"), [*keys, "family_b"])
        .where(can)
    )
    met = by_set.select("set_a", "set_b").unionByName(by_family.select("set_a", "set_b"))
    return met.select(F.least("set_a", "set_b").alias("set_a"), F.greatest("set_a", "set_b").alias("set_b")).distinct()


def near_pairs(prints: DataFrame, threshold: float = THRESHOLD, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Near-duplicate search over (id, hashes): pairs of classes (a, b, likeness), and the members (id, class).

    A class is a set of equal fingerprints, named by its smallest id (null only where it has no other), so that copies
    are not paired.
    """
    keyed = cut(prints.select("id", "hashes", print_key(F.col("hashes")).alias("print")))
    classes = keyed.groupBy("print").agg(F.min("id").alias("class"))
    links = near_classes(keyed, threshold, hot)
    a, b = (classes.select(F.col("print").alias(c), F.col("class").alias(f"class_{c}")) for c in "ab")
    pairs = links.join(a, "a").join(b, "b").select(
        F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"), "likeness"
    )
    return pairs, keyed.join(classes, "print").select("id", "class")


def _neighbours(entries: DataFrame) -> DataFrame:
    """(key, before, before_chars) from distinct (id, key, chars): the entry before it, by descending id.

    The first entry's is the last. Entries are dealt out by ranges; only one row for each range, its last
    entry, is put in order in one place.
    """
    order = [F.col("id").desc_nulls_last(), F.col("key")]
    dealt = cut(entries.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    inside = Window.partitionBy("range").orderBy(*order)
    backwards = Window.partitionBy("range").orderBy(F.col("id").asc_nulls_first(), F.col("key").desc())
    of_range = Window.orderBy("range")
    everything = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.struct("key", "chars")
    ends = (
        dealt.withColumn("place", F.row_number().over(backwards)).where("place = 1")
        .select("range", F.coalesce(F.lag(last).over(of_range), F.last(last).over(everything)).alias("end"))
    )
    return (
        dealt.withColumn("before", F.lag(last).over(inside))
        .join(ends, "range")
        .withColumn("before", F.coalesce("before", "end"))
        .select("key", F.col("before.key").alias("before"), F.col("before.chars").alias("before_chars"))
    )


def likeness_to_edits(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", chain: int = CHAIN
) -> DataFrame:
    """Fingerprints of each text and its edited text, and their likenesses, as the query op3 defines them.

    The near-duplicate search over all documents adds ``class_id``, the smallest id with the same fingerprint, and
    ``n_links``, the number of other classes with a likeness of at least ``THRESHOLD``. Rows of equal id and text
    count as one document.
    """
    rows = docs.select(docs[id_col].alias("id"), text_or_empty(docs[text]).alias("text")).withColumn(
        "key", F.unhex(F.md5(F.concat(text_or_empty("id"), F.lit("\n"), "text").cast("binary")))
    )
    hashes = signatures(F.col("text"), chain)
    # written tables that nothing reads once the small rows below are cut
    store = Folder(docs.sparkSession, f"{shared_checkpoint_dir(docs.sparkSession)}/spotsigs-{uuid.uuid4().hex}")
    written = []

    def keep(df: DataFrame) -> DataFrame:
        written.append(str(len(written)))
        df.write.parquet(f"{store.path}/{written[-1]}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{store.path}/{written[-1]}")

    prints = keep(
        rows.select("id", "key", F.length("text").alias("chars"), hashes.alias("hashes")).withColumn("print", print_key(F.col("hashes")))
    )
    entries = prints.select("id", "key", "chars").distinct()
    before = _neighbours(entries)
    # (before, class_id, n_links): small rows, which travel with what is sent to a document
    classes = prints.groupBy("print").agg(F.min("id").alias("class_id"))
    near = classes.join(link_counts(prints, keep=keep), "print", "left")
    named = prints.select(F.col("key").alias("before"), "print").distinct().join(near, "print").drop("print")
    before = cut(before.join(named.fillna(0, ["n_links"]), "before"))
    for name in written:
        store.delete(name)
    # what a document sends to the one before it: the beginning that is wanted there, and its fingerprint;
    # with its id, so that this and the last join read the same columns and share one shuffle of the texts
    sent = (
        rows.join(before, "key")
        .select(
            F.col("before").alias("to"),
            F.struct(
                F.col("id").alias("id"),
                "class_id",
                "n_links",
                F.left("text", F.floor(F.col("before_chars") / 2).cast("int")).alias("head"),
                signatures(F.col("text"), chain).alias("hashes"),
            ).alias("next"),
        )
        .groupBy("to")
        .agg(F.first("next").alias("next"))
    )
    chars = F.length("text")
    joined = rows.join(sent, F.col("key") == F.col("to")).select(
        "id",
        chars.cast("long").alias("n_chars"),
        "text",
        F.concat(F.left("text", chars - F.floor(chars / 2).cast("int")), F.col("next.head")).alias("edited"),
        F.col("next.hashes").alias("next"),
        F.col("next.id").alias("next_id"),
        F.col("next.class_id").alias("class_id"),
        F.col("next.n_links").alias("n_links"),
    )
    printed = joined.select(
        "id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        signatures(F.col("text"), chain).alias("own"), signatures(F.col("edited"), chain).alias("other"), "next", "next_id",
        "class_id", "n_links",
    )
    return printed.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        fingerprint_text(F.col("own")).alias("fingerprint"),
        fingerprint_text(F.col("other")).alias("edited_fingerprint"),
        pruned_jaccard(F.col("own"), F.col("other")).alias("near_edited"),
        pruned_jaccard(F.col("own"), F.col("next")).alias("near_next"),
        length_partition(F.size("own")).alias("partition"),
        "next_id",
        "class_id",
        "n_links",
    )
