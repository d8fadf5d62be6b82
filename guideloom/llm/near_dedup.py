"""Near-duplicate groups by bottom-k sketches from one hash function.

1. Each text becomes its set of word shingles, a sketch (the k smallest hashes of the set)
   and a digest of the whole set. Texts with one digest are one class; classes go on.
2. Inverted lists of the retained values. Two sets that are similar enough share at least
   `least_overlap` retained values, so each class needs lists only for its rarest values,
   all but that many; a class whose rarest values are its own alone needs none.
3. From each list come pairs with its most central class, the one with the least share of
   values of its own; an estimate from the sketch of the union drops most wrong pairs, and
   the exact Jaccard of the full sets decides. Where the other classes of a list then still
   lie in different groups, those classes get lists again, now from their full sets, and
   are paired across groups only. Short lists give pairs. In a long one the classes are
   described by their differences from one head: what must be a link by their weights hangs
   on one star, who cannot have a partner is left out, and the rest is listed again by
   shared differences (see around_heads). So n near copies cost about n pairs a list, not
   n * n, whether they link with each other or fall short of the threshold.
4. Groups are the connected components of the links, by rounds of joins on staged tables.

Shingles are compared as 63-bit hashes. The estimate and the overlap allow six standard
deviations of the sketch; sets within the sketch size are exact throughout.

Defined cases: null, empty or wordless texts have an empty set and are alone; texts shorter
than a shingle have one shingle, the whole; rows that share id and text fall in one class;
ties go to the smallest id; rows without an id belong to groups, and a group of such rows
alone has a null component; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ascii_lower, flat_words, in_arrow, slices, staged, texts_of

SKETCH, DEVIATIONS = 128, 6.0
#: Ids that one broadcast may hold; beyond that the documents are shuffled instead.
MAX_BROADCAST_IDS = 1_000_000
#: Classes of a list that are compared pair by pair, and rounds in which classes without a possible partner are left out.
MAX_LISTED, PRUNINGS = 32, 3


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct 63-bit hashes of each text's shingles."""
    row, words = flat_words(ascii_lower(texts))
    known = pd.util.hash_array(np.array(words.dictionary.to_pylist(), dtype=object), categorize=False) if len(words.dictionary) else np.zeros(0, dtype=np.uint64)
    word = known[words.indices.to_numpy(zero_copy_only=False)]
    counts = np.bincount(row, minlength=len(texts))
    ends = np.cumsum(counts)
    with np.errstate(over="ignore"):
        n = max(0, len(word) - width + 1)
        rolled = np.zeros(n, dtype=np.uint64)
        for k in range(width):
            rolled = _mixed(rolled + word[k : k + n] + np.uint64(k + 1))
        rolled >>= np.uint64(1)
        out = []
        for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
            if count >= width:
                out.append(np.unique(rolled[end - count : end - width + 1]))
            elif count:
                whole = np.array([count], dtype=np.uint64)
                for w in word[end - count : end]:
                    whole = _mixed(whole + w)
                out.append(whole >> np.uint64(1))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return [x.astype(np.int64) for x in out]


def _lists(sets: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, sets)])
    return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(np.concatenate(sets) if sets else np.zeros(0, dtype=np.int64)))


def shingle_sets(docs: DataFrame, width: int, most: int | None, carry: tuple[str, ...], text_col: str) -> DataFrame:
    """The columns carried, n_shingles, set_id (a digest of the set; null if empty) and values: the `most` smallest hashes, or all."""
    rows = docs.select(*carry, F.col(text_col).alias("_text"))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            sets = shingle_hashes(texts_of(batch, "_text"), width)
            ids = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([*map(batch.column, carry), pa.array([len(s) for s in sets], type=pa.int64()), pa.array(ids, type=pa.binary()), _lists([s[:most] for s in sets])], names=[*carry, "n_shingles", "set_id", "values"])

    return in_arrow(rows, make, f"{kinds}, n_shingles long, set_id binary, values array<bigint>")


def least_overlap(n: Column, threshold: float, k: int) -> Column:
    """Retained values that a class of n shingles shares at least with any class similar enough."""
    sampled = math.floor(k * threshold - DEVIATIONS * math.sqrt(k * threshold * (1 - threshold)))
    return F.when(n <= math.floor(k * threshold), F.ceil(n * threshold - 1e-9)).otherwise(F.lit(max(1, sampled))).cast("int")


def rarest_values(sets: DataFrame, least: Column) -> DataFrame:
    """(value, node, n, held, own, place): the lists in which a set stands: its rarest values, all but `least` of them and one, without those of no other set.

    sets: (node, n, values). held: its values, own: those of no other, place: that of the value among the rest, rarest first."""
    each = sets.select("node", F.explode("values").alias("value"))
    shared = each.groupBy("value").count().filter(F.col("count") > 1)
    place = F.row_number().over(Window.partitionBy("node").orderBy("count", "value"))
    ranked = each.join(shared, "value").withColumn("place", place).withColumn("among", F.count("*").over(Window.partitionBy("node")))
    held = F.size("values")
    sized = sets.select("node", "n", held.alias("held"), (held - least + 1).alias("needed"))
    ranked = ranked.join(sized, "node").withColumn("own", F.col("held") - F.col("among"))
    return ranked.filter(F.col("own") + F.col("place") <= F.col("needed")).select("value", "node", "n", "held", "own", "place")


def similar_length(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def may_be_similar(a: Column, b: Column, threshold: float, k: int) -> Column:
    """Whether the sketch of the union leaves the similarity possible. a, b: sketches. Exact when the union is within the sketch."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    common = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    of = F.size(union)
    slack = F.when(of < k, F.lit(1e-9)).otherwise(DEVIATIONS * F.sqrt(threshold * (1 - threshold) / of))
    return common >= (threshold - slack) * of


def full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(node, values): the full sets of classes, made again from the texts of their first documents."""
    wanted = staged(nodes.join(classes.select("node", F.col("first").alias("doc"), "set_id"), "node"), "near-wanted")
    ids = wanted.select(F.col("doc").alias("wanted")).distinct()
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    texts = texts.join(F.broadcast(ids) if wanted.count() <= MAX_BROADCAST_IDS else ids, F.col("doc").eqNullSafe(F.col("wanted")), "left_semi")
    made = shingle_sets(texts, width, None, ("doc",), "text").select("set_id", "values").join(wanted.select("node", "set_id"), "set_id")
    return staged(made.groupBy("node").agg(F.first("values").alias("values")), "near-full-sets")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, k: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach percent. Sets within the sketch are compared at once, others are made again from their texts."""
    threshold = percent / 100
    left = classes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("values").alias("v_a"))
    right = classes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("values").alias("v_b"))
    likely = staged(pairs.join(left, "a").join(right, "b").filter(may_be_similar(F.col("v_a"), F.col("v_b"), threshold, k)).select("a", "b", (F.greatest("n_a", "n_b") <= k).alias("whole"), F.size(F.array_intersect("v_a", "v_b")).alias("common"), "n_a", "n_b"), "near-likely")
    reaches = 100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))
    short = likely.filter(F.col("whole") & reaches).select("a", "b")
    long = likely.filter(~F.col("whole")).select("a", "b", "n_a", "n_b")
    if not long.limit(1).count():
        return staged(short, "near-links")
    full = full_sets(long.select(F.explode(F.array("a", "b")).alias("node")).distinct(), classes, docs, width, id_col, text_col)
    met = long.join(full.select(F.col("node").alias("a"), F.col("values").alias("v_a")), "a").join(full.select(F.col("node").alias("b"), F.col("values").alias("v_b")), "b")
    met = met.withColumn("common", F.size(F.array_intersect("v_a", "v_b"))).filter(reaches).select("a", "b")
    return staged(short.unionByName(met), "near-links")


def pairs_across(live: DataFrame, sets: DataFrame, percent: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(links, pairs) between classes (a, b) of different groups that share one of their rarest shingles. live: (node, n, label), sets: their full sets.

    Lists of up to `most` classes give their pairs, as far as bounds allow the similarity. Longer ones go by their differences from a head, see around_heads."""
    lists = rarest_values(live.join(sets, "node").select("node", "n", "values"), F.ceil(F.col("n") * (percent / 100) - 1e-9))
    lists = staged(lists.join(live.select("node", "label"), "node"), "near-open-lists")
    sizes = lists.groupBy("value").agg(F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
    lists = staged(lists.join(sizes.select("value", "members"), "value"), "near-sized-lists")
    few = lists.filter(F.col("members") <= most)
    x, y = few.alias("x"), few.alias("y")
    both = F.col("x.n") + F.col("y.n")
    # overlap: no more than either shares with anyone, nor than what comes from this place on
    top = F.least(F.col("x.n") - F.col("x.own"), F.col("y.n") - F.col("y.own"))
    onward = 1 + F.least(F.col("x.n") - F.col("x.own") - F.col("x.place"), F.col("y.n") - F.col("y.own") - F.col("y.place"))
    enough = lambda overlap: 100 * overlap >= percent * (both - overlap)
    on = (F.col("x.value") == F.col("y.value")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label")) & similar_length(F.col("x.n"), F.col("y.n"), percent) & enough(top) & enough(onward)
    pairs = x.join(y, on).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    many = lists.filter(F.col("members") > most)
    if not many.limit(1).count():
        return pairs.limit(0), staged(pairs, "near-across")
    links, more = around_heads(headed_groups(many), sets, percent, most)
    return links, staged(pairs.unionByName(more).distinct(), "near-across")


def headed_groups(lists: DataFrame) -> DataFrame:
    """(head, node, n, label): the classes of long lists, with a head for each list: the one that heads most of what its members are in, so that one family has few heads."""
    share = F.struct((F.col("own") / F.col("n")).alias("share"), "node")
    central = lists.groupBy("value").agg(F.min(share)["node"].alias("head"))
    known = staged(lists.join(central, "value").select("value", "node", "n", "label", "head"), "near-centres")
    popular = known.groupBy("head").agg(F.approx_count_distinct("node").alias("times"))
    first = F.max(F.struct("times", "head"))
    own = known.join(popular, "head").groupBy("node").agg(first.alias("best"))
    heads = known.select("value", "node").join(own, "node").groupBy("value").agg(F.max("best")["head"].alias("head"))
    members = known.drop("head").join(heads, "value").select("head", "node", "n", "label").distinct()
    selves = known.select(F.col("node").alias("head"), "node", "n", "label").join(heads.select("head").distinct(), "head", "left_semi").distinct()
    return staged(members.unionByName(selves).distinct(), "near-groups")


def around_heads(groups: DataFrame, sets: DataFrame, percent: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(links, pairs): the links that are certain and the pairs left to verify among classes of one head. groups: (head, node, n, label).

    With M what a class lacks of its head H and E what it adds, two classes have
    |H| - |M1| - |M2| + |D1 & D2| shingles in common, where D = M + E. With the weight
    w = (100 + percent) |M| + percent n they are linked if and only if
    w1 + w2 <= (100 + percent) (|H| + |D1 & D2|). So in a list of classes that share k
    differences, all pairs with w1 + w2 <= (100 + percent) (|H| + k) are links and hang
    together by the links of the class of least weight: a star, not pairs. Every other link
    shares a further difference. Classes whose weight no partner's shared differences make
    up for are left out; short lists give pairs; long ones are cut up by the next
    difference, rarest first, as many of them as leave enough behind (prefix filter)."""
    unit = 100 + percent
    mine, heads = sets.select("node", F.col("values").alias("mine")), sets.select(F.col("node").alias("head"), F.col("values").alias("of"))
    diff = groups.join(mine, "node").join(heads, "head")
    lack, add = F.array_except("of", "mine"), F.array_except("mine", "of")
    diff = staged(diff.select("head", "node", "label", (unit * F.size(lack) + percent * F.col("n")).cast("long").alias("weight"), (unit * F.size("of")).cast("long").alias("bound"), F.concat(lack, add).alias("differences")), "near-differences")
    each = diff.select("head", "node", F.explode("differences").alias("d"))
    shared = each.groupBy("head", "d").agg(F.count("*").alias("times")).filter("times > 1")
    ranked = each.join(shared, ["head", "d"]).groupBy("head", "node").agg(F.transform(F.array_sort(F.collect_list(F.struct("times", "d"))), lambda x: x["d"]).alias("rest"))
    rest = F.coalesce("rest", F.array().cast("array<bigint>"))
    lists = staged(diff.drop("differences").join(ranked, ["head", "node"], "left").select(F.xxhash64("head").alias("list"), "node", "label", "weight", "bound", rest.alias("rest")), "near-level")

    links, pairs, level = [], [], 0
    while True:
        lists = lists.withColumn("most", level + F.size("rest"))  # differences that it can share with another
        least = lists.groupBy("list").agg(F.min(F.struct("weight", "node", "label")).alias("least"))
        star = lists.join(least, "list").withColumn("certain", F.col("weight") + F.col("least.weight") <= F.col("bound") + unit * level)
        links.append(star.filter(F.col("certain") & (F.col("label") != F.col("least.label"))).select(F.col("least.node").alias("a"), F.col("node").alias("b")))
        star = star.withColumn("label", F.when(F.col("certain"), F.col("least.label")).otherwise(F.col("label"))).withColumn("inner", F.col("label") == F.col("least.label")).drop("least", "certain")
        for _ in range(PRUNINGS):
            room = unit * F.col("most") - F.col("weight")
            outer = ~F.col("inner")
            ends = star.groupBy("list").agg(F.min("weight").alias("low"), F.max(room).alias("room"), F.min(F.when(outer, F.col("weight"))).alias("outer_low"), F.max(F.when(outer, room)).alias("outer_room"))
            # a class of the star needs a partner outside it
            low, space = F.when(F.col("inner"), F.col("outer_low")).otherwise(F.col("low")), F.when(F.col("inner"), F.col("outer_room")).otherwise(F.col("room"))
            star = staged(star.drop("low").join(ends, "list").withColumn("low", low).filter((F.col("weight") + F.col("low") <= F.col("bound") + unit * F.col("most")) & (F.col("weight") <= F.col("bound") + space)).drop("room", "outer_low", "outer_room"), "near-level")
        open_lists = star.groupBy("list").agg(F.count("*").alias("members"), F.min("label").alias("first"), F.max("label").alias("last")).filter("first != last").select("list", "members")
        star = staged(star.join(open_lists, "list"), "near-level")
        few = star.filter(F.col("members") <= most).select("list", "node", "label", "weight", "bound", "most")
        x, y = few.alias("x"), few.alias("y")
        on = (F.col("x.list") == F.col("y.list")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.label") != F.col("y.label")) & (F.col("x.weight") + F.col("y.weight") <= F.col("x.bound") + unit * F.least("x.most", "y.most"))
        pairs.append(x.join(y, on).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
        many = star.filter(F.col("members") > most)
        if not many.limit(1).count():
            break
        needed = F.greatest(F.lit(1), F.ceil((F.col("weight") + F.col("low") - F.col("bound")) / unit).cast("int") - level)
        parts = many.withColumn("places", F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("rest") - needed + 1))).filter(F.size("rest") >= needed)
        cut = parts.select("*", F.explode("places").alias("place"))
        lists = staged(cut.select(F.xxhash64("list", F.element_at("rest", F.col("place"))).alias("list"), "node", "label", "weight", "bound", F.expr("slice(rest, place + 1, size(rest))").alias("rest")), "near-level")
        level += 1
    union = lambda found: staged(reduce(DataFrame.unionByName, found).distinct(), "near-found")
    return union(links), union(pairs)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of the edges (a, b) reaches. Rounds of joins: the least label around, then the label of the label."""
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "cc-labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near")).withColumnRenamed("a", "node")
        lower = labels.join(around, "node").select("node", "label", F.least("label", "near").alias("low"))
        roots = labels.select(F.col("node").alias("low"), F.col("label").alias("root"))
        labels = staged(lower.join(roots, "low").select("node", F.least("low", "root").alias("label"), (F.least("low", "root") != F.col("label")).alias("moved")), "cc-labels")
        moved = labels.filter("moved").limit(1).count()
        labels = labels.select("node", "label")
        if not moved:
            return labels


def text_digest(text: Column) -> Column:
    return F.coalesce(F.xxhash64(text), F.lit(0))


def labelled(docs: DataFrame, width: int, percent: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """One row a document: doc_id, digest (of the text), n_shingles, label (the same in its group; null if the set is empty), component_id."""
    threshold = percent / 100
    rows = docs.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest"), F.col(text_col).alias("text"))
    sets = staged(shingle_sets(rows, width, k, ("doc_id", "digest"), "text"), "near-sets")
    classes = sets.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("first"), F.first("n_shingles").alias("n"), F.first("values").alias("values"))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")

    lists = staged(rarest_values(classes, least_overlap(F.col("n"), threshold, k)).withColumn("share", F.col("own") / F.col("held")).select("value", "node", "n", "share"), "near-lists")
    heads = lists.groupBy("value").agg(F.min(F.struct("share", "node", "n")).alias("head"))
    headed = lists.join(heads, "value").filter(F.col("head.node") != F.col("node"))
    pairs = headed.filter(similar_length(F.col("n"), F.col("head.n"), percent)).select(F.least("node", "head.node").alias("a"), F.greatest("node", "head.node").alias("b")).distinct()
    links = verified(pairs, classes, docs, percent, k, width, id_col, text_col)
    labels = components(links)

    # lists whose classes, but for the central one, still lie in different groups
    rest = headed.join(labels, "node", "left").select("value", "node", "n", F.coalesce("label", "node").alias("label"))
    open_lists = rest.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("value")
    live = staged(rest.join(open_lists, "value").select("node", "n", "label").distinct(), "near-live")
    if live.limit(1).count():
        certain, more = pairs_across(live, full_sets(live.select("node"), classes, docs, width, id_col, text_col), percent, MAX_LISTED)
        if more.limit(1).count():
            certain = certain.unionByName(verified(more, classes, docs, percent, k, width, id_col, text_col))
        labels = components(staged(links.unionByName(certain), "near-all-links"))

    named = classes.select("set_id", "first", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("first").alias("component"))
    named = named.join(least, "label").select("set_id", "label", "component")
    keyed = sets.select("doc_id", "digest", "n_shingles", F.coalesce("set_id", F.unhex(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))).alias("key"))
    return keyed.join(named.withColumnRenamed("set_id", "key"), "key", "left").select("doc_id", "digest", "n_shingles", "label", F.coalesce("component", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, k: int = SKETCH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the smallest id in its group), kept (it has that id)."""
    out = labelled(docs, width, percent, k, id_col, text_col).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, k: int = SKETCH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without all but the first row of each near-duplicate group; columns as in docs. First: of least id, rows without an id last, then of least digest of the text; of rows that share both, any one. Rows without shingles are in no group: all of them stay, also those that repeat."""
    found = staged(labelled(docs, width, percent, k, id_col, text_col), "near-found")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest").alias("place")
    grouped = found.filter("label is not null").select("label", place)
    groups = grouped.groupBy("label").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    groups = staged(groups.filter("rows > 1"), "near-first")
    met = staged(grouped.join(groups, "label").select("place", (F.col("place") == F.col("first")).alias("stays")), "near-met")
    gone = met.filter("not stays").select(F.col("place.doc_id").alias("id"), F.col("place.digest").alias("digest")).distinct()
    same = docs[id_col].eqNullSafe(gone["id"]) & (text_digest(docs[text_col]) == gone["digest"])
    left = docs.join(F.broadcast(gone) if gone.count() <= MAX_BROADCAST_IDS else gone, same, "left_anti")
    several = met.filter("stays").groupBy("place").count().filter("count > 1").select(F.col("place.doc_id").alias("id"), F.col("place.digest").alias("digest"))
    if several.limit(1).count():
        several = staged(several, "near-several")
        again = left[id_col].eqNullSafe(several["id"]) & (text_digest(left[text_col]) == several["digest"])
        left = left.join(several, again, "left_anti").unionByName(left.join(several, again, "left_semi").dropDuplicates([id_col, text_col]))
    return left.select(docs.columns)
