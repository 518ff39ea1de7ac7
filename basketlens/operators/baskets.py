"""Market baskets: pairs of items bought together, rules and itemsets."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.dataset import Dataset
from basketlens.functions.joins import lookup
from basketlens.functions.ordering import top_per_group
from basketlens.functions.scalars import ratio, total_of
from basketlens.functions.shared_tables import written_table
from basketlens.operators.facts import category_of_product

BIG_BASKET = 1000  # distinct items from which all pairs are no longer listed
PARTNER_SALTS = 64


def basket_lines(ds: Dataset, item: str = "category") -> DataFrame:
    """(order_id, item, n): item rows per order and category or product.
    Rows without item stay, with a null item: they make the basket longer."""
    items = ds.order_items.select("order_id", "product_id")
    if item == "category":
        items = lookup(items, category_of_product(ds), "product_id")
    elif item == "product":
        items = items.withColumn("product", F.col("product_id"))
    else:
        raise ValueError(f"unknown basket item: {item}")
    return items.groupBy("order_id", F.col(item).alias("item")).agg(F.count("*").alias("n"))


def basket_stats(lines: DataFrame) -> DataFrame:
    """Number of baskets and mean basket length, repeats included."""
    per_basket = lines.groupBy("order_id").agg(F.sum("n").alias("length"))
    return per_basket.agg(F.count("*").alias("baskets"), ratio(F.sum("length"), F.count("*")).alias("avg_length"))


def _promising(lines: DataFrame, min_count: Column) -> DataFrame:
    """Rows whose item can be part of a pair that reaches ``min_count``.

    In one basket an item adds at most n * (largest n of the basket) to any
    of its pairs; an item whose sum of these bounds is too small is in no
    frequent pair.
    """
    baskets = lines.groupBy("basket").agg(F.count("*").alias("items"), F.max("n").alias("most")).filter("items > 1")
    shared = lookup(lines, baskets.select("basket", "most"), "basket", "inner")
    bounds = shared.groupBy("item").agg(F.sum(F.col("n") * F.col("most")).alias("bound"))
    able = bounds.filter(F.col("bound") >= min_count).select("item")
    return lookup(shared, able, "item", "inner", counted=lines).drop("most")


def _listed_pairs(lines: DataFrame) -> DataFrame:
    left = lines.select("basket", F.col("item").alias("item_1"), F.col("n").alias("n_1"))
    right = lines.select("basket", F.col("item").alias("item_2"), F.col("n").alias("n_2"))
    both = left.join(right, "basket").filter(F.col("item_1") < F.col("item_2"))
    return both.groupBy("item_1", "item_2").agg(F.sum(F.col("n_1") * F.col("n_2")).alias("n"))


def pair_counts(lines: DataFrame, min_count: int | Column, big_basket: int = BIG_BASKET) -> DataFrame:
    """(item_1, item_2, n) with item_1 < item_2 and n = sum of n_1 * n_2 over
    the baskets, at least ``min_count``.

    ``lines`` is (basket, item, n), one row per basket and item, no null
    items.  Pairs are listed only from items that can matter, and not from
    the largest of the baskets beyond ``big_basket`` items: see ``_with_big``.
    """
    least = F.lit(min_count) if isinstance(min_count, int) else min_count
    kept = written_table(_promising(written_table(lines, "all-lines"), least), "basket-lines")
    sizes = kept.groupBy("basket").agg(F.count("*").alias("items"))
    largest, needed = sizes.agg(F.coalesce(F.max("items"), F.lit(0))).select("*", F.ceil(least)).first()
    # a pair seen once per basket needs a basket besides the needed - 1 largest
    if largest <= big_basket or needed <= 1:
        return _listed_pairs(kept).filter(F.col("n") >= least)
    huge = sizes.filter(F.col("items") > big_basket).orderBy(F.desc("items"), "basket").limit(int(needed) - 1)
    huge = written_table(huge.select("basket"), "huge-baskets")
    usual = _listed_pairs(kept.join(huge, "basket", "left_anti"))
    big = kept.join(huge, "basket", "left_semi")
    return _with_big(written_table(usual, "usual-pairs"), written_table(big, "big-baskets"), least).filter(F.col("n") >= least)


def _with_big(usual: DataFrame, big: DataFrame, least: Column) -> DataFrame:
    """Add the big baskets to the pair counts of the usual ones.

    A frequent pair either occurs in a usual basket, or gets all of its
    count from the k < ``least`` big baskets, and then at least ``least / k``
    (more than 1) from one of them.  So in the second case one of its items
    repeats in that basket, and starting from the repeated items finds it.
    """
    k = total_of(big, F.count_distinct("basket"))
    most = big.groupBy("basket").agg(F.max("n").alias("most"))
    able = lookup(big, most, "basket", "inner").filter(F.col("n") * F.col("most") * k >= least).drop("most")
    strong = able.filter(F.col("n") * F.col("n") * k >= least).select(
        "basket", F.col("item").alias("a"), F.col("n").alias("n_a"), F.explode(F.sequence(F.lit(0), F.lit(PARTNER_SALTS - 1))).alias("salt")
    )
    partners = able.select(
        "basket", F.col("item").alias("b"), F.col("n").alias("n_b"), F.pmod(F.hash("item"), F.lit(PARTNER_SALTS)).alias("salt")
    )
    heavy = strong.join(partners, ["basket", "salt"]).filter(
        (F.col("a") != F.col("b")) & (F.col("n_a") * F.col("n_b") * k >= least)
    )
    only_big = heavy.select(F.least("a", "b").alias("item_1"), F.greatest("a", "b").alias("item_2"))
    candidates = usual.select("item_1", "item_2").unionByName(only_big).distinct()

    first = big.select("basket", F.col("item").alias("item_1"), F.col("n").alias("n_1"))
    second = big.select("basket", F.col("item").alias("item_2"), F.col("n").alias("n_2"))
    found = lookup(lookup(candidates, first, "item_1", "inner"), second, ["basket", "item_2"], "inner")
    extra = found.select("item_1", "item_2", (F.col("n_1") * F.col("n_2")).alias("n"))
    return usual.unionByName(extra).groupBy("item_1", "item_2").agg(F.sum("n").alias("n"))


def frequent_pairs(lines: DataFrame, min_support: float = 0.01, big_basket: int = BIG_BASKET) -> DataFrame:
    """Pairs of distinct items in at least ``min_support`` of all baskets."""
    total = total_of(lines, F.count_distinct("order_id"))
    once = lines.filter(F.col("item").isNotNull()).select(F.col("order_id").alias("basket"), "item", F.lit(1).cast("long").alias("n"))
    pairs = pair_counts(once, total * F.lit(min_support), big_basket)
    return pairs.withColumn("support", ratio(F.col("n"), total))


def item_supports(lines: DataFrame) -> DataFrame:
    """(item, support): the share of baskets with the item."""
    total = total_of(lines, F.count_distinct("order_id"))
    counts = lines.filter(F.col("item").isNotNull()).groupBy("item").agg(F.count("*").alias("n"))
    return counts.select("item", ratio(F.col("n"), total).alias("item_support"))


def association_rules(
    lines: DataFrame, min_support: float = 0.01, min_confidence: float = 0.3, min_lift: float = 1.0
) -> DataFrame:
    """antecedent -> consequent with support, confidence and lift."""
    pairs = frequent_pairs(lines, min_support)
    both = pairs.select(F.col("item_1").alias("antecedent"), F.col("item_2").alias("consequent"), "support").unionByName(
        pairs.select(F.col("item_2").alias("antecedent"), F.col("item_1").alias("consequent"), "support")
    )
    supports = item_supports(lines)
    known = both.join(supports.withColumnsRenamed({"item": "antecedent", "item_support": "_s1"}), "antecedent").join(
        supports.withColumnsRenamed({"item": "consequent", "item_support": "_s2"}), "consequent"
    )
    rules = known.withColumn("confidence", F.col("support") / F.col("_s1")).withColumn(
        "lift", F.col("confidence") / F.col("_s2")
    )
    strong = rules.filter((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))
    return strong.select("antecedent", "consequent", "support", "confidence", "lift")


def basket_recommend(rules: DataFrame, baskets: DataFrame, k: int = 5) -> DataFrame:
    """For every basket (basket, item), the ``k`` best items of matching rules
    that are not in it yet; score = best confidence * lift."""
    held = baskets.select("basket", "item").distinct()
    scored = lookup(
        held.withColumnRenamed("item", "antecedent"),
        rules.select("antecedent", "consequent", (F.col("confidence") * F.col("lift")).alias("score")),
        "antecedent",
        "inner",
    )
    best = scored.groupBy("basket", F.col("consequent").alias("item")).agg(F.max("score").alias("score"))
    new = best.join(held, ["basket", "item"], "left_anti")
    return top_per_group(new, ["basket"], [F.desc("score"), F.asc("item")], k).withColumn("method", F.lit("market_basket"))


def frequent_itemsets_fpgrowth(lines: DataFrame, min_support: float = 0.01) -> DataFrame:
    """Itemsets of any size by FP-growth: (items, freq).

    Only items that are frequent themselves enter the lists, so a list has at
    most (mean basket size / min_support) items, however long the basket.
    """
    frequent = item_supports(lines).filter(F.col("item_support") >= min_support).select("item")
    kept = lookup(lines.filter(F.col("item").isNotNull()), frequent, "item", "inner")
    lists = kept.groupBy("order_id").agg(F.collect_set("item").alias("items"))
    # every basket counts in the denominator, also one without frequent items
    all_baskets = lines.select("order_id").distinct()
    baskets = all_baskets.join(lists, "order_id", "left").select(F.coalesce("items", F.array()).alias("items"))
    return FPGrowth(itemsCol="items", minSupport=min_support).fit(baskets).freqItemsets


def itemset_rules(
    lines: DataFrame, min_support: float = 0.01, min_confidence: float = 0.3, min_lift: float = 1.0
) -> DataFrame:
    """antecedent (a sorted array of one or more items) -> consequent, with
    support, confidence and lift, from frequent itemsets of all sizes.

    A frequent set of n items has n subsets of n - 1 items, all of them
    frequent, so every rule is a set joined to one a step below it; nothing
    is counted again."""
    sets = frequent_itemsets_fpgrowth(lines, min_support).select(F.array_sort("items").alias("items"), "freq")
    sets = written_table(sets, "itemsets")
    total = total_of(lines, F.count_distinct("order_id"))
    each = sets.filter(F.size("items") > 1).select("items", "freq", F.explode("items").alias("consequent"))
    steps = each.select("consequent", F.filter("items", lambda x: x != F.col("consequent")).alias("antecedent"), "freq")
    below = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_below"))
    single = sets.filter(F.size("items") == 1).select(F.get("items", F.lit(0)).alias("consequent"), F.col("freq").alias("_single"))
    known = lookup(steps.join(below, "antecedent"), single, "consequent", "inner")
    confidence = ratio(F.col("freq"), F.col("_below"))
    rules = known.select(
        "antecedent",
        "consequent",
        ratio(F.col("freq"), total).alias("support"),
        confidence.alias("confidence"),
        (confidence / ratio(F.col("_single"), total)).alias("lift"),
    )
    return rules.filter((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))


def basket_recommend_sets(rules: DataFrame, baskets: DataFrame, k: int = 5) -> DataFrame:
    """As ``basket_recommend``, by rules of ``itemset_rules``: a rule matches
    when the basket holds all items of its antecedent.

    A basket meets a rule at one item only, the one that the fewest rules
    have, and the others are looked up in the basket's own list."""
    rules = written_table(rules.select("antecedent", "consequent", (F.col("confidence") * F.col("lift")).alias("score")), "set-rules")
    used = rules.select(F.explode("antecedent").alias("item")).groupBy("item").agg(F.count("*").alias("_rules"))
    held = baskets.filter(F.col("basket").isNotNull() & F.col("item").isNotNull()).select("basket", "item").distinct()
    # Items of no rule matter to no match.
    own = lookup(held, used, "item", "inner").drop("_rules")
    lists = own.groupBy("basket").agg(F.collect_set("item").alias("held"))
    places = rules.withColumn("item", F.explode("antecedent"))
    rarest = lookup(places, used, "item", "inner").groupBy("antecedent", "consequent").agg(
        F.min(F.struct("_rules", "item"))["item"].alias("item"), F.first("score").alias("score")
    )
    met = lookup(lists.withColumn("item", F.explode("held")), rarest, "item", "inner")
    matched = met.filter(F.size(F.array_except("antecedent", "held")) == 0)
    best = matched.groupBy("basket", F.col("consequent").alias("item")).agg(F.max("score").alias("score"))
    new = best.join(held, ["basket", "item"], "left_anti")
    return top_per_group(new, ["basket"], [F.desc("score"), F.asc("item")], k).withColumn("method", F.lit("market_basket"))
