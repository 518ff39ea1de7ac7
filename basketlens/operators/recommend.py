"""Product recommendations for all customers at once: popularity,
co-purchase, hybrid, category-aware and ensemble."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketlens.dataset import Dataset
from basketlens.functions.joins import fits_broadcast, lookup
from basketlens.functions.ordering import global_rank, rank_in_group, top_per_group
from basketlens.functions.scalars import ratio, total_of, whole_days
from basketlens.functions.shared_tables import written_table
from basketlens.operators.baskets import BIG_BASKET, basket_lines, pair_counts
from basketlens.operators.facts import category_of_product, purchases
from basketlens.sources.retail_files import load_model, save_model

SHORT_LIST = 512  # ranks of a list that are matched as one array per customer
RUN_LENGTH = 4096  # ranks generated per row for customers beyond that
HUB_BUYERS = 1000  # a hub is bought by at least 1/HUB_BUYERS of the customers
HUB_PARTNERS = 100  # and has more co-purchase partners than this
HUB_SALTS = 64
MAX_K = 50  # fixed value: the largest number of recommendations served
EVERYTHING = "all"
POPULAR_ABOVE = 100  # fixed value: purchases that make a product "popular"
ENSEMBLE_WEIGHTS = {"popularity": 0.3, "content": 0.3, "category": 0.4}  # fixed values


def popularity(ds: Dataset) -> DataFrame:
    """(product_id, category, purchase_count): item rows per product."""
    counts = ds.order_items.groupBy("product_id").agg(F.count("*").alias("purchase_count"))
    return counts.join(category_of_product(ds), "product_id", "left")


def copurchase_pairs(ds: Dataset, min_support: int = 5, big_basket: int = BIG_BASKET) -> DataFrame:
    """Directed pairs of products bought in one order, counted line by line:
    a product on two lines counts twice, and forms a pair with itself."""
    lines = basket_lines(ds, "product").filter(F.col("item").isNotNull()).withColumnRenamed("order_id", "basket")
    pairs = pair_counts(lines, min_support, big_basket)
    twice = lines.filter(F.col("n") > 1).groupBy("item").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("n"))
    same = twice.filter(F.col("n") >= min_support)
    columns = ("product_id_1", "product_id_2", "co_purchase_count")
    return (
        pairs.select("item_1", "item_2", "n")
        .union(pairs.select("item_2", "item_1", "n"))
        .union(same.select("item", "item", "n"))
        .toDF(*columns)
    )


class Recommender:
    """A fitted recommender: two tables.

    popularity: product_id, category, purchase_count, list_id, rank
    pairs: product_id_1, product_id_2, co_purchase_count; a function that
    makes them is called when they are first read
    """

    def __init__(self, popularity: DataFrame, pairs: DataFrame | Callable[[], DataFrame]):
        self.popularity = popularity
        self._pairs = pairs

    @cached_property
    def pairs(self) -> DataFrame:
        return self._pairs if isinstance(self._pairs, DataFrame) else self._pairs()

    @staticmethod
    def fit(ds: Dataset, min_support: int = 5) -> "Recommender":
        """Pairs are mined only for methods that read them."""
        order = [F.desc("purchase_count"), F.asc("product_id")]
        ranked = global_rank(popularity(ds), order).withColumn("list_id", F.lit(EVERYTHING))
        return Recommender(written_table(ranked, "popularity"), lambda: written_table(copurchase_pairs(ds, min_support), "pairs"))

    def save(self, path: str) -> None:
        save_model({"popularity": self.popularity, "pairs": self.pairs}, path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Recommender":
        return Recommender(**load_model(spark, path, ["popularity", "pairs"]))


def all_people(ds: Dataset) -> DataFrame:
    """Everybody who can be recommended to: (who)."""
    return ds.customers.select(F.col("customer_unique_id").alias("who")).filter(F.col("who").isNotNull()).distinct()


def bought_products(ds: Dataset) -> DataFrame:
    """(who, product_id), distinct."""
    return purchases(ds).select(F.col("customer_unique_id").alias("who"), "product_id")


def first_unlisted(ranking: DataFrame, wants: DataFrame, excluded: DataFrame, k: int, short: int = SHORT_LIST) -> DataFrame:
    """The best ``need`` entries of a ranked list that are not excluded.

    ranking: (list_id, rank 1.., product_id, ...), wants: (who, list_id,
    need <= k), excluded: (who, list_id, product_id), distinct.  Returns
    wants' keys with the ranking's columns.

    Nobody is paired with the whole list.  With t excluded entries among the
    first ``short`` ranks, ranks 1..t+need hold enough, and an array
    difference picks them.  The few with more exclusions than fit get ranks
    1..(all their exclusions)+need as rows, in runs, which is no more than
    the exclusions they came with.
    """
    keys = ["who", "list_id"]
    taken = lookup(excluded, ranking.select("list_id", "product_id", "rank"), ["list_id", "product_id"], "inner")
    counted = taken.groupBy(*keys).agg(
        F.count("*").alias("n_taken"), F.collect_set(F.when(F.col("rank") <= short, F.col("rank"))).alias("near")
    )
    sized = wants.join(counted, keys, "left").select(
        *keys,
        F.col("need").cast("long").alias("need"),
        F.coalesce("n_taken", F.lit(0)).alias("n_taken"),
        F.coalesce("near", F.array().cast("array<bigint>")).alias("near"),
    ).filter("need > 0")
    reach = F.size("near") + F.col("need")
    free = F.array_except(F.sequence(F.lit(1).cast("long"), reach), F.col("near"))
    easy = sized.filter(reach <= short).select(*keys, F.explode(F.slice(free, F.lit(1), F.col("need").cast("int"))).alias("rank"))

    last = F.col("n_taken") + F.col("need")
    runs = sized.filter(reach > short).select(
        *keys, "need", last.alias("last"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor((last - 1) / RUN_LENGTH))).alias("run")
    ).repartition("who", "list_id", "run")
    start = F.col("run") * RUN_LENGTH
    slots = runs.select(
        *keys, "need", F.explode(F.sequence(start + 1, F.least(F.col("last"), start + RUN_LENGTH))).alias("rank")
    )
    open_slots = slots.join(taken.select(*keys, "rank"), [*keys, "rank"], "left_anti")
    hard = top_per_group(open_slots, keys, [F.asc("rank")], k, "_i").filter(F.col("_i") <= F.col("need"))
    chosen = easy.unionByName(hard.select(*keys, "rank"))
    if not fits_broadcast(ranking):  # hot keys are counted first
        chosen = written_table(chosen, "chosen")
    return lookup(chosen, ranking, ["list_id", "rank"], "inner")


def _numbered(recs: DataFrame, k: int) -> DataFrame:
    """Number the recommendations of each customer, best first."""
    return top_per_group(recs, ["who"], [F.desc("score"), F.asc("product_id")], k)


def _result(recs: DataFrame) -> DataFrame:
    return recs.select(
        F.col("who").alias("customer_id"), F.col("rank").cast("int"), "product_id", F.col("score").cast("double"), "method"
    )


class History:
    """What people bought, and their best ``k`` products by co-purchase:
    written when first read, and shared by the methods that get it."""

    def __init__(self, model: Recommender, ds: Dataset, k: int = 5):
        self._model, self._ds, self._k = model, ds, k

    @cached_property
    def bought(self) -> DataFrame:
        return written_table(bought_products(self._ds), "bought")

    @cached_property
    def copurchase(self) -> tuple[DataFrame, DataFrame]:
        best, paired = copurchase_scores(self.bought, self._model.pairs, self._k)
        return written_table(best, "best"), paired


def recommend_popular(model: Recommender, ds: Dataset, people: DataFrame | None = None, k: int = 5, history: History | None = None) -> DataFrame:
    """The most bought products the customer has not bought yet."""
    wants = (people if people is not None else all_people(ds)).select("who").withColumns(
        {"list_id": F.lit(EVERYTHING), "need": F.lit(k)}
    )
    excluded = (history or History(model, ds, k)).bought.withColumn("list_id", F.lit(EVERYTHING))
    found = first_unlisted(model.popularity, wants, excluded, k)
    scored = found.select("who", "product_id", F.col("purchase_count").alias("score"))
    return _result(_numbered(scored, k).withColumn("method", F.lit("popularity")))


def _partners(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("product_id_1").alias("product_id"), F.col("product_id_2").alias("partner"), "co_purchase_count")


def _summed(found: DataFrame) -> DataFrame:
    return found.groupBy("who", F.col("partner").alias("product_id")).agg(F.sum("co_purchase_count").alias("score"))


def _partner_scores(bought: DataFrame, pairs: DataFrame) -> DataFrame:
    """(who, product_id, score): summed counts of the partners of all bought
    products, none of which is a hub.  A product so common that its lookup is
    spread (1/HUB_BUYERS of the rows) has at most HUB_PARTNERS partners."""
    return _summed(lookup(bought, _partners(pairs), "product_id", "inner", hot_limit=HUB_BUYERS))


def _hub_scores(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """The same for sets of hubs, whose many partners are spread by salt."""
    salted = _partners(pairs).withColumn("salt", F.pmod(F.hash("partner"), F.lit(HUB_SALTS)))
    copies = members.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(HUB_SALTS - 1))))
    return _summed(copies.join(salted, ["product_id", "salt"]))


def hub_products(bought: DataFrame, pairs: DataFrame, buyers: int = HUB_BUYERS, partners: int = HUB_PARTNERS) -> DataFrame:
    """Products with many buyers and many partners: listing every partner for
    every buyer would be most of the work."""
    people = total_of(bought, F.count_distinct("who"))
    wide = pairs.groupBy(F.col("product_id_1").alias("product_id")).agg(F.count("*").alias("p")).filter(F.col("p") > partners)
    counts = bought.groupBy("product_id").agg(F.count("*").alias("b"))
    return counts.join(wide, "product_id").filter(F.col("b") * buyers >= people).select("product_id")


def copurchase_scores(
    bought: DataFrame, pairs: DataFrame, k: int, buyers: int = HUB_BUYERS, partners: int = HUB_PARTNERS
) -> tuple[DataFrame, DataFrame]:
    """The best ``k`` new products per customer by summed pair counts, and the
    customers who have any pair at all: ((who, product_id, score), (who)).

    Customers who bought the same hubs share the hubs' part of the scores.
    It is computed and ranked once per set of hubs; a customer needs only
    the best entries of it that no other bought product touches.
    """
    hubs = written_table(hub_products(bought, pairs, buyers, partners), "hubs")
    if hubs.isEmpty():
        scores = written_table(_partner_scores(bought, pairs), "copurchase")
        best = _numbered(scores.join(bought, ["who", "product_id"], "left_anti"), k).drop("rank")
        return best, scores.select("who").distinct()

    of_hubs = lookup(bought, hubs, "product_id", "inner")
    sets = of_hubs.groupBy("who").agg(F.array_sort(F.collect_set("product_id")).alias("hubs"))
    sets = written_table(sets.withColumn("list_id", F.md5(F.concat_ws(",", F.col("hubs").cast("array<string>")))), "hub-sets")
    members = sets.select("list_id", "hubs").distinct().select(F.col("list_id").alias("who"), F.explode("hubs").alias("product_id"))
    shared = _hub_scores(members, pairs).withColumnRenamed("who", "list_id")
    ranking = written_table(rank_in_group(shared, "list_id", [F.desc("score"), F.asc("product_id")]), "hub-lists")

    own = written_table(_partner_scores(bought.join(hubs, "product_id", "left_anti"), pairs), "copurchase")
    list_of = sets.select("who", "list_id")
    placed = own.join(list_of, "who", "left")
    added = ranking.select("list_id", "product_id", F.col("score").alias("hub_score"))
    both = placed.join(added, ["list_id", "product_id"], "left").select(
        "who", "product_id", (F.col("score") + F.coalesce("hub_score", F.lit(0))).alias("score")
    )
    excluded = (
        bought.unionByName(own.select("who", "product_id")).distinct().join(list_of, "who")
    )
    wants = list_of.withColumn("need", F.lit(k))
    from_hubs = first_unlisted(ranking, wants, excluded, k).select("who", "product_id", "score")
    own_new = both.join(bought, ["who", "product_id"], "left_anti")
    best = _numbered(own_new.unionByName(from_hubs), k).drop("rank")
    return best, own.select("who").unionByName(list_of.select("who")).distinct()


def recommend_copurchase(model: Recommender, ds: Dataset, people: DataFrame | None = None, k: int = 5, history: History | None = None) -> DataFrame:
    """Partners of the customer's products by summed pair counts; customers
    without any pair get popular products."""
    people = (people if people is not None else all_people(ds)).select("who")
    history = history or History(model, ds, k)
    best, paired = history.copurchase
    found = best.join(people, "who", "left_semi").withColumn("method", F.lit("copurchase"))
    ranked = top_per_group(found, ["who"], [F.desc("score"), F.asc("product_id")], k)
    others = recommend_popular(model, ds, people.join(paired, "who", "left_anti"), k, history)
    return _result(ranked).unionByName(others)


def recommend_hybrid(model: Recommender, ds: Dataset, people: DataFrame | None = None, k: int = 5, history: History | None = None) -> DataFrame:
    """Co-purchase first, filled up with popular products."""
    people = (people if people is not None else all_people(ds)).select("who")
    history = history or History(model, ds, k)
    bought, (best, _) = history.bought, history.copurchase
    found = written_table(
        _numbered(best.join(people, "who", "left_semi"), k).withColumn("method", F.lit("copurchase")), "hybrid"
    )
    counts = found.groupBy("who").agg(F.count("*").alias("have"))
    wants = people.join(counts, "who", "left").select(
        "who", F.lit(EVERYTHING).alias("list_id"), (F.lit(k) - F.coalesce("have", F.lit(0))).alias("need")
    ).filter("need > 0")
    excluded = bought.unionByName(found.select("who", "product_id")).withColumn("list_id", F.lit(EVERYTHING))
    filler = first_unlisted(model.popularity, wants, excluded, k)
    order = W.partitionBy("who").orderBy(F.desc("purchase_count"), F.asc("product_id"))
    filler = filler.withColumn("i", F.row_number().over(order)).join(wants.select("who", "need"), "who").select(
        "who",
        (F.lit(k) - F.col("need") + F.col("i")).alias("rank"),
        "product_id",
        F.col("purchase_count").alias("score"),
        F.lit("popularity").alias("method"),
    )
    return _result(found).unionByName(_result(filler))


METHODS = {"popularity": recommend_popular, "copurchase": recommend_copurchase, "hybrid": recommend_hybrid}


def recommend(
    model: Recommender, ds: Dataset, method: str = "hybrid", people: DataFrame | None = None, k: int = 5, history: History | None = None
) -> DataFrame:
    """Recommendations by a named method, 1 to 50 per customer.  A
    ``history`` of the same model, data and k saves work for several methods."""
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    if not 1 <= k <= MAX_K:
        raise ValueError(f"k must be between 1 and {MAX_K}")
    return METHODS[method](model, ds, people, k, history)


def category_lists(ds: Dataset) -> DataFrame:
    """All products ranked by purchases within their category; products never
    bought come last with popularity 0."""
    sales = ds.order_items.groupBy("product_id").agg(F.count("*").alias("n"))
    listed = category_of_product(ds).filter(F.col("category").isNotNull()).join(sales, "product_id", "left")
    ranked = listed.select("product_id", F.col("category").alias("list_id"), F.coalesce("n", F.lit(0)).alias("popularity"))
    return written_table(rank_in_group(ranked, "list_id", [F.desc("popularity"), F.asc("product_id")]), "category-lists")


def recommend_category(ds: Dataset, people: DataFrame | None = None, k: int = 5, favourites: int = 3) -> DataFrame:
    """The most popular new products of the customer's favourite categories,
    the same number from each."""
    bought = purchases(ds).withColumnRenamed("customer_unique_id", "who")
    if people is not None:
        bought = bought.join(people.select("who"), "who", "left_semi")
    bought = written_table(bought, "purchases")
    named = written_table(lookup(bought, category_of_product(ds), "product_id").filter(F.col("category").isNotNull()), "named")
    tallies = named.groupBy("who", F.col("category").alias("list_id")).agg(F.sum("n").alias("n"))
    liked = top_per_group(tallies, ["who"], [F.desc("n"), F.asc("list_id")], favourites, "place")
    number = F.count("*").over(W.partitionBy("who"))  # at most `favourites` rows
    liked = written_table(liked.withColumn("need", F.greatest(F.lit(1), F.floor(F.lit(k) / number))), "favourites")
    excluded = named.select("who", F.col("category").alias("list_id"), "product_id")
    found = first_unlisted(category_lists(ds), liked.select("who", "list_id", "need"), excluded, k)
    placed = found.drop("rank").join(liked.select("who", "list_id", "place"), ["who", "list_id"])
    ranked = top_per_group(placed, ["who"], [F.asc("place"), F.desc("popularity"), F.asc("product_id")], k)
    return _result(ranked.select("who", "rank", "product_id", F.col("popularity").alias("score"), F.lit("category_aware").alias("method")))


def recommend_ensemble(
    parts: dict[str, DataFrame], weights: dict[str, float] | None = None, k: int = 5, normalize: bool = False
) -> DataFrame:
    """Weighted sum of the scores of several methods, each given as its own
    recommendations; ``normalize`` first divides by the method's best score."""
    weights = weights or ENSEMBLE_WEIGHTS
    total = None
    for name, recs in parts.items():
        score = F.col("score")
        if normalize:
            score = ratio(score, total_of(recs, F.max("score")))
        part = recs.select(F.col("customer_id").alias("who"), "product_id", (score * weights[name]).alias("score"))
        total = part if total is None else total.unionByName(part)
    summed = total.groupBy("who", "product_id").agg(F.sum("score").alias("score"))
    return _result(_numbered(summed.withColumn("score", F.round("score", 9)), k).withColumn("method", F.lit("ensemble")))


def explain_recommendation(ds: Dataset, requests: DataFrame) -> DataFrame:
    """Why a product suits a customer, for every (who, product_id) asked."""
    sales = ds.order_items.groupBy("product_id").agg(F.count("*").alias("popularity"))
    known = category_of_product(ds).withColumn("known", F.lit(True)).join(sales, "product_id", "left")
    asked = lookup(written_table(requests.select("who", "product_id").distinct(), "asked"), known, "product_id")
    own = lookup(written_table(purchases(ds), "purchases"), category_of_product(ds), "product_id").groupBy(
        F.col("customer_unique_id").alias("who"), "category"
    ).agg(F.sum("n").alias("in_category"))
    facts = asked.join(own, ["who", "category"], "left")
    # The texts of the reasons.
    popular = F.when(
        F.col("popularity") > POPULAR_ABOVE, F.concat(F.lit("Popular product ("), F.col("popularity"), F.lit(" purchases)"))
    )
    familiar = F.when(
        F.col("in_category") > 0,
        F.concat(F.lit("You've purchased "), F.col("in_category"), F.lit(" items from "), F.col("category"), F.lit(" category")),
    )
    reasons = F.array_compact(F.array(popular, familiar))
    return facts.select(
        F.col("who").alias("customer_id"),
        "product_id",
        "category",
        F.when(F.col("known").isNull(), F.array(F.lit("Product not found")))
        .when(F.size(reasons) == 0, F.array(F.lit("Trending product in our store")))
        .otherwise(reasons)
        .alias("reasons"),
    )


def temporal_weights(ds: Dataset, half_life_days: float = 30) -> DataFrame:
    """(order_id, days_ago, temporal_weight): 0.5 ** (days_ago / half life)."""
    latest = total_of(ds.orders, F.max("order_purchase_timestamp"))
    aged = ds.orders.select("order_id", whole_days(F.col("order_purchase_timestamp"), latest).alias("days_ago"))
    return aged.withColumn("temporal_weight", F.pow(F.lit(0.5), F.col("days_ago") / F.lit(float(half_life_days))))


def decayed_popularity(ds: Dataset, half_life_days: float = 30) -> DataFrame:
    """Item rows per product, recent orders weighing more."""
    weights = temporal_weights(ds, half_life_days).select("order_id", "temporal_weight")
    weighted = lookup(ds.order_items.select("order_id", "product_id"), weights, "order_id", "inner")
    return weighted.groupBy("product_id").agg(F.sum("temporal_weight").alias("weight"), F.count("*").alias("purchase_count"))


def user_item_interactions(ds: Dataset) -> DataFrame:
    """(person, product, purchases) with dense indices from 0 for both."""
    found = written_table(purchases(ds).withColumnRenamed("n", "purchases"), "interactions")

    def index(column: str, name: str) -> DataFrame:
        # one row per key: numbered by a distributed rank, not on the driver
        keys = found.select(F.col(column)).distinct()
        return global_rank(keys, [F.asc(column)]).select(column, (F.col("rank") - 1).alias(name))

    indexed = lookup(found, index("customer_unique_id", "user_index"), "customer_unique_id", "inner")
    return lookup(indexed, index("product_id", "item_index"), "product_id", "inner").select(
        "customer_unique_id", "product_id", "user_index", "item_index", "purchases"
    )
