"""Learn and remove the sentences that a firm repeats in its advertisements.

Columns used throughout: ``firm``, ``offer_id``, ``sentences`` and ``keys`` (two
aligned arrays), ``key``, ``n_docs`` (offers of the firm that hold the key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerscope.functions import text as X
from offerscope.operators.joins import BROADCAST_BYTES, fits_broadcast, lookup_join
from offerscope.operators.key_clusters import cluster_keys
from offerscope.operators.sampling import keep_first_by_hash
from offerscope.session import materialize

# The drop rule and the similarity of near-duplicate keys.
SHARE_THRESHOLD = 0.10
MIN_COUNT = 2
SIM_THRESHOLD = 0.88
SHORT_RESULT_CHARS = 150

# Partial top lists per firm before the final one.
KEY_SALTS = 64
# Offers of a key from which it is spread over salts.
HOT_DOCS = 10_000
# Per-firm arrays of drop keys ride on every offer row of the broadcast path.
FIRM_ARRAY_BYTES = 256 * 1024


def segment_offers(
    offers: DataFrame,
    id_col: str,
    text_col: str,
    firm_col: str,
    remove_accents: bool = True,
    collapse_digits: bool = True,
    max_tokens: int | None = None,
    lower: bool = True,
    keep_row: bool = False,
) -> DataFrame:
    """``offer_id, firm, sentences, keys`` per offer; a null firm becomes ''.

    ``keep_row`` adds the whole input row as ``row``, so that removal can give it
    back without a join.
    """
    text = F.lower(F.col(text_col)) if lower else F.col(text_col)
    row = [F.struct("*").alias("row")] if keep_row else []
    return (
        offers.select(
            F.col(id_col).alias("offer_id"),
            X.stripped(F.coalesce(F.col(firm_col), F.lit(""))).alias("firm"),
            X.sentence_lines(text).alias("_lines"),
            *row,
        )
        .select(
            *(["row"] if keep_row else []),
            "offer_id",
            "firm",
            X.sentences_of(F.col("_lines")).alias("sentences"),
            X.sentence_keys_of(
                F.col("_lines"), remove_accents, collapse_digits, max_tokens, lower=not lower
            ).alias("keys"),
        )
    )


def firm_sizes(offers: DataFrame) -> DataFrame:
    """Offers per named firm; offers without text count."""
    return offers.filter(F.col("firm") != "").groupBy("firm").agg(F.count("*").alias("n_offers"))


def cap_offers(segmented: DataFrame, cap: int, seed: int = 0) -> DataFrame:
    """At most ``cap`` offers of each firm, drawn by hash order."""
    return keep_first_by_hash(segmented, ["firm"], "offer_id", cap, seed)


def _distinct_keys(segmented: DataFrame) -> DataFrame:
    """One row per offer and distinct key: duplicates go inside the row, so no
    shuffle is needed for them. ``_row`` tells offers apart, whose ids may be null or
    shared."""
    return (
        segmented.filter(F.col("firm") != "")
        .withColumn("_row", F.monotonically_increasing_id())
        .select("firm", "_row", F.explode(F.array_distinct("keys")).alias("key"))
        .filter(F.col("key") != "")
    )


def key_document_frequency(segmented: DataFrame) -> DataFrame:
    return _distinct_keys(segmented).groupBy("firm", "key").agg(F.count("*").alias("n_docs"))


def top_keys(frequency: DataFrame, max_keys: int) -> DataFrame:
    """The ``max_keys`` most frequent keys of each firm with their ``rank``.

    Exact in two steps: the best of each salted share, then the best of those,
    so one firm's keys never meet in one task unfiltered.
    """
    order = [F.col("n_docs").desc(), F.col("key")]
    shares = Window.partitionBy("firm", "_salt").orderBy(*order)
    firm = Window.partitionBy("firm").orderBy(*order)
    return (
        frequency.withColumn("_salt", F.pmod(F.xxhash64("key"), F.lit(KEY_SALTS)))
        .withColumn("_share_rank", F.row_number().over(shares))
        .filter(F.col("_share_rank") <= max_keys)
        .drop("_salt", "_share_rank")
        .withColumn("rank", F.row_number().over(firm))
        .filter(F.col("rank") <= max_keys)
    )


def drop_floor(n_offers: Column, share: float, min_count: int) -> Column:
    """Smallest document frequency that makes a key or cluster boilerplate."""
    return F.greatest(F.lit(min_count).cast("long"), F.ceil(F.lit(float(share)) * n_offers))


def _exact_drop_keys(
    frequency: DataFrame, sizes: DataFrame, share: float, min_count: int, max_keys: int | None
) -> DataFrame:
    """Drop keys without clustering: those that reach the floor.

    They are the head of the frequency order, so where ``max_keys`` is given,
    filtering before ranking gives the same ranks on far fewer rows.
    """
    frequent = lookup_join(
        frequency.filter(F.col("n_docs") >= min_count), sizes, ["firm"]
    ).filter(F.col("n_docs") >= drop_floor(F.col("n_offers"), share, min_count))
    return (frequent if max_keys is None else top_keys(frequent, max_keys)).select("firm", "key")


# --- clusters ---------------------------------------------------------------------


def _clusters(frequency: DataFrame, max_keys: int | None, threshold: float) -> DataFrame:
    keys = frequency if max_keys is None else top_keys(frequency, max_keys)
    return materialize(cluster_keys(keys, threshold), "key-clusters")


def _member_hits(rows: DataFrame, members: DataFrame) -> DataFrame:
    """``rows`` of member keys with their cluster. Beyond a broadcast, only keys of many
    offers, which are few, are joined with salts."""
    on = ["firm", "key"]
    if fits_broadcast(members):
        return rows.join(F.broadcast(members), on)
    hot = F.col("n_docs") > HOT_DOCS
    rare = lookup_join(rows, members.filter(~hot), on, salts=1, few_match=True)
    return rare.unionByName(lookup_join(rows, members.filter(hot), on, few_match=True))


def cluster_document_frequency(segmented: DataFrame, clusters: DataFrame) -> DataFrame:
    """``firm, cluster_id, df_offers``: offers with at least one member key.

    A cluster of one key already has its count. Only keys of larger clusters are
    looked up in the offers again. ``clusters`` must be materialised.
    """
    single = clusters.filter(F.col("n_members") == 1).select(
        "firm", "cluster_id", F.col("n_docs").alias("df_offers")
    )
    members = clusters.filter(F.col("n_members") > 1).select("firm", "key", "cluster_id", "n_docs")
    hits = _member_hits(_distinct_keys(segmented), members)
    several = (
        hits.groupBy("firm", "cluster_id", "_row")
        .agg(F.lit(1).alias("one"))
        .groupBy("firm", "cluster_id")
        .agg(F.count("*").alias("df_offers"))
    )
    return single.unionByName(several)


def learn_boilerplate(
    segmented: DataFrame,
    share_threshold: float = SHARE_THRESHOLD,
    min_count: int = MIN_COUNT,
    sim_threshold: float = SIM_THRESHOLD,
    max_keys_per_firm: int | None = None,
    max_offers_per_firm: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """The materialised table ``firm, key`` of sentence keys to remove.

    ``sim_threshold=1.0`` takes each key for itself.
    """
    if max_offers_per_firm is not None:
        segmented = cap_offers(segmented, max_offers_per_firm, seed)
    sizes = materialize(firm_sizes(segmented), "firm-sizes")
    frequency = key_document_frequency(segmented)
    if sim_threshold >= 1.0:
        drops = _exact_drop_keys(frequency, sizes, share_threshold, min_count, max_keys_per_firm)
        return materialize(drops, "drop-keys")
    clusters = _clusters(frequency, max_keys_per_firm, sim_threshold)
    floor = drop_floor(F.col("n_offers"), share_threshold, min_count)
    # The document frequency lies between the largest member's and the sum of
    # all; only clusters whose verdict these bounds leave open are counted.
    bounds = lookup_join(
        clusters.groupBy("firm", "cluster_id").agg(
            F.max("n_docs").alias("least"), F.sum("n_docs").alias("most")
        ),
        sizes,
        ["firm"],
    ).withColumn("floor", floor)
    verdicts = materialize(bounds.filter(F.col("most") >= F.col("floor")), "cluster-bounds")
    certain = verdicts.filter(F.col("least") >= F.col("floor")).select("firm", "cluster_id")
    unsure = verdicts.filter(F.col("least") < F.col("floor"))
    of_cluster = ["firm", "cluster_id"]
    open_clusters = materialize(
        lookup_join(clusters, unsure.select(*of_cluster), of_cluster, "left_semi"), "open-clusters"
    )
    counted = (
        cluster_document_frequency(segmented, open_clusters)
        .join(unsure, ["firm", "cluster_id"])
        .filter(F.col("df_offers") >= F.col("floor"))
        .select("firm", "cluster_id")
    )
    chosen = materialize(certain.unionByName(counted), "chosen-clusters")
    drops = lookup_join(clusters.select(*of_cluster, "key"), chosen, of_cluster, "left_semi")
    return materialize(drops.select("firm", "key"), "drop-keys")


def boilerplate_report(
    segmented: DataFrame,
    sim_threshold: float = SIM_THRESHOLD,
    max_keys_per_firm: int | None = None,
) -> DataFrame:
    """``firm, cluster_id, df_offers, share, n_members, rep`` for every cluster.

    Order for reading: ``df_offers`` and ``n_members`` descending.
    """
    sizes = materialize(firm_sizes(segmented), "firm-sizes")
    clusters = _clusters(key_document_frequency(segmented), max_keys_per_firm, sim_threshold)
    heads = clusters.filter(F.col("key") == F.col("rep")).select(
        "firm", "cluster_id", "n_members", "rep", "n_docs"
    )
    # a cluster of one key has its count and its name in its own row
    alone = heads.filter(F.col("n_members") == 1).withColumnRenamed("n_docs", "df_offers")
    several = clusters.filter(F.col("n_members") > 1)
    named = heads.filter(F.col("n_members") > 1).drop("n_docs")
    counted = cluster_document_frequency(segmented, several).join(named, ["firm", "cluster_id"]).unionByName(alone)
    return lookup_join(counted, sizes, ["firm"]).select(
        "firm",
        "cluster_id",
        "df_offers",
        (F.col("df_offers") / F.col("n_offers")).alias("share"),
        "n_members",
        "rep",
    )


# --- removal --------------------------------------------------------------------


def _with_dropped(segmented: DataFrame, drop_keys: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``segmented`` with ``dropped``: the places of the sentences to remove.

    When the drop table is measured small, each firm's keys travel to the offers
    by broadcast and nothing is shuffled. Otherwise keys, places and ids are
    shuffled, where a broadcast filter of the drop keys does not rule them out first, and
    the sentences move once to meet the answer.
    """
    none = F.array().cast("array<int>")
    by_firm = drop_keys.groupBy("firm").agg(F.collect_list("key").alias("_drops"))
    widest = drop_keys.groupBy("firm").agg(F.sum(F.octet_length("key") + 16).alias("w"))
    if (
        fits_broadcast(drop_keys, limit)
        and (widest.agg(F.max("w")).first()[0] or 0) <= FIRM_ARRAY_BYTES
    ):
        found = (
            segmented.join(F.broadcast(by_firm), "firm", "left")
            .withColumn("_hits", F.array_intersect("keys", "_drops"))
            .drop("_drops")
        )
        places = F.filter(
            F.transform("keys", lambda key, i: F.when(F.array_contains("_hits", key), i)),
            lambda place: place.isNotNull(),
        )
        has_hits = F.coalesce(F.size("_hits") > 0, F.lit(False))
        return found.withColumn("dropped", F.when(has_hits, places).otherwise(none)).drop("_hits")
    # rows are told apart by their place in a stored table: ids may be null or shared
    segmented = materialize(segmented.withColumn("_place", F.monotonically_increasing_id()), "segmented")
    placed = segmented.filter(F.col("firm") != "").select(
        "firm", "_place", F.posexplode("keys").alias("place", "key")
    )
    hits = lookup_join(placed.filter(F.col("key") != ""), drop_keys, ["firm", "key"], limit=limit, few_match=True)
    by_offer = hits.groupBy("_place").agg(F.collect_list("place").alias("_places"))
    return (
        segmented.join(by_offer, "_place", "left")
        .withColumn("dropped", F.coalesce("_places", none))
        .drop("_places", "_place")
    )


def _kept_text() -> Column:
    kept = F.filter("sentences", lambda _, place: ~F.array_contains("dropped", place))
    sentences = F.when(F.size("dropped") == 0, F.col("sentences")).otherwise(kept)
    return X.minimal_clean(F.array_join(sentences, " "))


def remove_boilerplate(segmented: DataFrame, drop_keys: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``offer_id`` (or the kept row) with ``description_clean``: the sentences
    that stay, in order.

    An offer made only of boilerplate gives an empty string. ``drop_keys`` must
    be materialised, as ``learn_boilerplate`` returns it; above ``limit`` bytes it is not
    broadcast.
    """
    return _with_dropped(segmented, drop_keys, limit).select(
        "row.*" if "row" in segmented.columns else "offer_id",
        _kept_text().alias("description_clean"),
    )


def explain_removal(segmented: DataFrame, drop_keys: DataFrame) -> DataFrame:
    """What removal does to each offer: sentences kept and removed, lengths, and
    whether the result is short."""
    return (
        _with_dropped(segmented, drop_keys)
        .select(
            "offer_id",
            F.size(F.filter("sentences", lambda s: s != "")).alias("n_sentences"),
            F.size("dropped").alias("n_removed"),
            F.length(F.array_join("sentences", " ")).alias("raw_len"),
            F.length(_kept_text()).alias("out_len"),
        )
        .select(
            "offer_id",
            (F.col("n_sentences") - F.col("n_removed")).alias("n_kept"),
            "n_removed",
            "raw_len",
            "out_len",
            (F.col("out_len") < SHORT_RESULT_CHARS).alias("is_short"),
        )
    )


def removed_sentences(segmented: DataFrame, drop_keys: DataFrame) -> DataFrame:
    """``offer_id, pos, sentence, key, removed`` for reading single offers."""
    return (
        _with_dropped(segmented, drop_keys)
        .select("offer_id", "dropped", F.posexplode(F.arrays_zip("sentences", "keys")))
        .select(
            "offer_id",
            "pos",
            F.col("col.sentences").alias("sentence"),
            F.col("col.keys").alias("key"),
            F.array_contains("dropped", F.col("pos")).alias("removed"),
        )
        .filter(F.col("sentence") != "")
    )


def phrase_lookup(segmented: DataFrame, phrase: str, examples: int = 5) -> DataFrame:
    """Per firm: sentences that hold ``phrase``, their distinct keys, and the
    first keys in alphabetical order."""
    hits = (
        segmented.withColumn("firm", X.normalised_name(F.col("firm")))
        .select("firm", F.explode(F.arrays_zip("sentences", "keys")).alias("s"))
        .filter(F.contains(F.lower("s.sentences"), F.lit(phrase.lower())))
        .groupBy("firm", F.col("s.keys").alias("key"))
        .agg(F.count("*").alias("n"))
    )
    # Few firms hold the phrase in many forms: the alphabetical head is found
    # per salted share first, the totals add up what the shares counted.
    shares = hits.withColumn("_salt", F.pmod(F.xxhash64("key"), F.lit(KEY_SALTS)))
    order = Window.partitionBy("firm", "_salt").orderBy("key")
    return (
        shares.withColumn("_rank", F.row_number().over(order))
        .groupBy("firm")
        .agg(
            F.sum("n").alias("n_occurrences"),
            F.count("*").alias("n_keys"),
            F.slice(
                F.array_sort(F.collect_list(F.when(F.col("_rank") <= examples, F.col("key")))),
                1,
                examples,
            ).alias("examples"),
        )
    )
