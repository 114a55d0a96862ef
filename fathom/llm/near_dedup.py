"""Near-duplicate groups by SuperMinHash.

1. Each text becomes its set of k-word shingles (64-bit hashes), a 128-bit
   digest of the set and a SuperMinHash signature cut into bands.
2. Texts with equal sets form a *class*; from here on only classes are
   compared, so copies cost nothing.
3. Classes that share a band key meet in a bucket.  Every member is verified
   against one centre of its bucket on the full sets (no pairs within a bucket),
   and components of the links found are labelled; first the centre is the
   member that meets the most others, then, where a bucket still holds several
   components, the one with the least share of rare shingles.
4. Buckets that hold several components even then are finished exactly: over their
   members, shingles are ordered from rare to frequent, and two classes of
   different components can reach the similarity only if they share one of
   their first ones (prefix filter) at places that leave enough to share
   (positional filter) with sizes that fit (size classes in the join key).
   Those pairs are verified on the full sets.

So links are lost only if no band of two similar texts agrees, with
probability (1 - s^rows)^bands: below 1e-5 a pair at s = 0.85 for 16 x 4 and
below 1e-6 at s = 0.8 for 21 x 3.

Defined results: texts without words, or null, have no shingles and stand
alone; texts with fewer words than a shingle have one shingle, all their
words; rows with a null id are left out of all groups (component null, kept);
rows that repeat an id and text share its result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm import superminhash, textbatch
from fathom.llm.registry import query, table
from fathom.llm.stored import components, stored
from fathom.session import small_side

SALTS = 16
PAIRS_PER_SALT = 2048   # pairs of one centre that go to one task


def shingle_sets(texts: pa.Array, k: int):
    """(first text, texts, element hashes, owner of each element), sorted and distinct within a text."""
    for w in textbatch.words(texts):
        grams, owners = [], []
        for n in range(1, k + 1):
            g = textbatch.gram_hashes(w.hash, n)
            own = w.text[:len(g)]
            whole = own == w.text[n - 1:] if len(g) else np.zeros(0, dtype=bool)
            if n < k:
                whole &= w.count[own] == n
            grams.append(textbatch.mix(g[whole] + np.uint64(n)))
            owners.append(own[whole])
        g, own = np.concatenate(grams), np.concatenate(owners)
        order = np.lexsort((g, own))
        g, own = g[order], own[order]
        first = np.ones(len(g), dtype=bool)
        first[1:] = (g[1:] != g[:-1]) | (own[1:] != own[:-1])
        yield w.first, w.n_texts, g[first], own[first]


def _set_digests(g: np.ndarray, own: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two 64-bit digests of each set (sums of mixed elements; empty: 0)."""
    ends = np.concatenate([[0], np.searchsorted(own, np.arange(n_texts), side="right")])
    out = []
    for salt in (0x1B873593A5A5A5A5, 0xCC9E2D5155555555):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(textbatch.mix(g ^ np.uint64(salt)), dtype=np.uint64)])
        out.append(textbatch.mix(run[ends[1:]] - run[ends[:-1]] + np.uint64(1)))
    return np.diff(ends), out[0], out[1]


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n (shingles), d1, d2 (digest of the set), bands (keys) of each text."""
    slots = bands * rows

    def run(batches):
        for b in batches:
            ids = b.column(b.schema.get_field_index("doc_id"))
            for first, n_texts, g, own in shingle_sets(b.column(b.schema.get_field_index("text")), k):
                n, d1, d2 = _set_digests(g, own, n_texts)
                sig = superminhash.signatures(g, own, n_texts, slots)
                keys = superminhash.band_keys(sig, bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n_texts + 1, dtype=np.int32) * bands),
                                                 pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, n_texts), pa.array(n.astype(np.int64)), pa.array(d1.view(np.int64)),
                     pa.array(d2.view(np.int64)), lists], names=["doc_id", "n", "d1", "d2", "bands"])

    return docs.mapInArrow(run, "doc_id long, n long, d1 long, d2 long, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """cls, n, shingles of the wanted classes (cls, rep), read again from the text of their first document."""
    chosen = docs.join(small_side(wanted.select(F.col("rep").alias("doc_id"), "cls")), "doc_id").select("cls", "text")

    def run(batches):
        for b in batches:
            cls = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for first, n_texts, g, own in shingle_sets(b.column(1), k):
                n, d1, _ = _set_digests(g, own, n_texts)
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(g.view(np.int64)))
                out = pa.RecordBatch.from_arrays([pa.array(d1.view(np.int64)), pa.array(n.astype(np.int64)), lists],
                                                 names=["cls", "n", "shingles"])
                yield out.filter(pa.array(d1 == cls[first:first + n_texts]))   # another text under the same id

    return chosen.mapInArrow(run, "cls long, n long, shingles array<long>")


def _enough(common: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """100 * common >= percent * union, without the union."""
    return (100 + percent) * common >= percent * (n_a + n_b)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, ...) whose full sets reach the similarity.

    ``a`` may be the centre of very many pairs: its set is handed out once for
    every PAIRS_PER_SALT of them.
    """
    pairs = stored(pairs, "pairs")
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_SALT).cast("int").alias("parts"))
    salted = pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    left = (sets.join(parts, F.col("cls") == F.col("a"))
            .select("a", F.col("n").alias("n_1"), F.col("shingles").alias("s_1"),
                    F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
    right = sets.select(F.col("cls").alias("b"), F.col("n").alias("n_2"), F.col("shingles").alias("s_2"))
    return (salted.join(left, ["a", "part"]).join(right, "b")
            .filter(_enough(F.size(F.array_intersect("s_1", "s_2")), F.col("n_1"), F.col("n_2"), percent))
            .select(*pairs.columns))


def _with_labels(df: DataFrame, labels: list[DataFrame]) -> DataFrame:
    """df (with cls) plus label: its component, found through one table after the other."""
    df = df.withColumn("label", F.col("cls"))
    for step in labels:
        named = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        df = df.join(named, "label", "left").withColumn("label", F.coalesce("next", "label")).drop("next")
    return df


def _joined(links: DataFrame) -> list[DataFrame]:
    """Components of links (label_a, label_b) between labels, none if there are no links."""
    links = stored(links.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")), "links")
    return [components(links)] if links.limit(1).count() else []


def _open(members: DataFrame, labels: list[DataFrame]) -> DataFrame:
    """key, cls, n, label of the members of buckets that hold several labels."""
    labelled = _with_labels(members.select("key", "cls", "n"), labels)
    keys = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    return labelled.join(keys.select("key"), "key").select("key", "cls", "n", "label")


def _size_class(n: Column) -> Column:
    """Classes of sizes about two percent wide."""
    return F.floor(F.log(n.cast("double")) * 50).cast("int")


def star_pairs(members: DataFrame, weights: DataFrame, percent: int) -> DataFrame:
    """(a, b) and their labels: the heaviest member of each bucket with each member of another label whose size fits."""
    centre = F.max(F.struct("weight", F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("label").alias("label_a")))
    best = members.join(weights, "cls").groupBy("key").agg(centre.alias("c")).select("key", "c.*")
    return (members.join(best, "key").filter((F.col("label") != F.col("label_a"))
                                             & _enough(F.least("n", "n_a"), F.col("n"), F.col("n_a"), percent))
            .select("a", F.col("cls").alias("b"), "label_a", F.col("label").alias("label_b")).distinct())


def by_rarity(sets: DataFrame) -> DataFrame:
    """cls, n, s: what a set shares with others as (df, shingle) from rare to frequent, df counted over these sets.

    The n - size(s) shingles that no other set has come before these.
    """
    each = sets.select("cls", "n", F.explode("shingles").alias("shingle"))
    freq = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = each.join(freq, "shingle").groupBy("cls", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("s"))
    return sets.select("cls", "n").join(shared.select("cls", "s"), "cls", "left").withColumn(
        "s", F.coalesce("s", F.array().cast("array<struct<df:bigint,shingle:bigint>>")))


def prefix_pairs(ranked: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, label_a, label_b) of different labels that the prefix and positional filters leave.

    ``ranked``: cls, n, label, s as ``by_rarity`` gives it.  Of two classes of
    different labels at least one is outside the label that is most frequent on
    a shingle; only those look for partners.
    """
    n = F.col("n")
    keep = (n - F.ceil(percent * n / 100) + 1).cast("int")
    own = (n - F.size("s")).cast("int")    # shingles of no other set, the first places
    places = stored(ranked.select("cls", "n", "label", own.alias("own"),
                                  F.posexplode(F.slice("s", 1, F.greatest(keep - own, F.lit(0)))).alias("i", "x"))
                    .select("cls", "n", "label", (F.col("own") + F.col("i")).alias("at"),
                            F.col("x.shingle").alias("shingle")), "prefixes")
    votes = places.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("votes"))
    main = votes.groupBy("shingle").agg(F.max(F.struct("votes", "label")).alias("m"), F.count(F.lit(1)).alias("labels"))
    main = stored(main.filter("labels > 1").select("shingle", F.col("m.label").alias("main")), "postings")
    seekers = places.join(main, "shingle").filter(F.col("label") != F.col("main"))
    # the most that a partner may have if this is the first shared shingle, and the least it must have
    most = F.least(F.floor((100 + percent) * (n - F.col("at")) / percent) - n, F.floor(100 * n / percent))
    seekers = (seekers.withColumn("least", F.ceil(percent * n / 100)).withColumn("most", most).filter("most >= least")
               .withColumn("size", F.explode(F.sequence(_size_class(F.col("least")), _size_class(F.col("most"))))))
    x = seekers.select("shingle", "size", F.col("cls").alias("a"), F.col("label").alias("label_a"),
                       F.col("n").alias("n_a"), F.col("at").alias("at_a"))
    y = places.join(main.select("shingle"), "shingle").select(
        "shingle", _size_class(n).alias("size"), F.col("cls").alias("b"), F.col("label").alias("label_b"),
        F.col("n").alias("n_b"), F.col("at").alias("at_b"))
    left = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    found = x.join(y, ["shingle", "size"]).filter(
        (F.col("label_a") != F.col("label_b")) & _enough(left, F.col("n_a"), F.col("n_b"), percent))
    return found.select("a", "b", "label_a", "label_b").distinct()


def near_groups(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = 21, rows: int = 3,
                id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id of the group), kept of each row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    named = docs.filter("doc_id IS NOT NULL")
    sig = stored(signatures(docs, k, bands, rows), "signatures")
    classes = stored(sig.filter("doc_id IS NOT NULL AND n > 0").groupBy("d1", "d2", "n", "bands").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("rows"))
        .select(F.col("d1").alias("cls"), "rep", "n", "bands", "rows"), "classes")

    slots = classes.select("cls", "n", F.explode("bands").alias("key"))
    shared = stored(slots.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "buckets")
    members = stored(slots.join(shared, "key").withColumn("label", F.col("cls")), "members")
    inside = members.groupBy("cls").agg(F.sum("size").alias("weight"))
    sets = stored(full_sets(named, classes.join(inside, "cls").select("cls", "rep"), k), "sets")

    # first against the member that meets the most others
    labels = _joined(verified(star_pairs(members, inside, percent), sets, percent))
    # buckets with several components: against the member with the least share of rare shingles
    opened = stored(_open(members, labels), "open")
    ranked = stored(by_rarity(sets.join(opened.select("cls").distinct(), "cls")), "ranked")
    rare = F.aggregate("s", (F.col("n") - F.size("s")).cast("double"), lambda acc, x: acc + 1 / x["df"])
    weights = ranked.select("cls", (-rare / F.col("n")).alias("weight"))
    labels += _joined(verified(star_pairs(opened, weights, percent), sets, percent))
    # what still lies in different components of one bucket: the exact finish
    opened = _open(opened.select("key", "cls", "n"), labels).select("cls", "label").distinct()
    labels += _joined(verified(prefix_pairs(ranked.join(opened, "cls"), percent), sets, percent))

    grouped = _with_labels(classes.select("cls", "rep", "rows"), labels)
    smallest = grouped.groupBy("label").agg(F.min("rep").alias("component_id"))
    per_class = grouped.join(smallest, "label").select("cls", "rep", "rows", "component_id")
    # copies look their class up under a salt each; a class of one row under the salt of its only id
    spread = lambda c: F.pmod(F.xxhash64(c), F.lit(salts)).cast("int")
    offered = per_class.select("cls", "component_id", F.explode(
        F.when(F.col("rows") > 1, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(spread("rep")))).alias("part"))
    out = (sig.select("doc_id", "n", F.when(F.col("n") > 0, F.col("d1")).alias("cls"), spread("doc_id").alias("part"))
           .join(offered, ["cls", "part"], "left"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs that stay when one document of each group does."""
    gone = near_groups(docs, **options).filter("NOT kept").select("doc_id").distinct()
    return docs.join(small_side(gone), "doc_id", "left_anti").select(*docs.columns)


@query("op3_superminhash_near_dedup")
def op3_superminhash_near_dedup(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents"), k=3, percent=85, bands=16, rows=4)
