"""Customer-product counts and exact nearest customers by cosine similarity.

Similarity is ranked by ``dot^2 / |b|^2`` for a fixed customer a. Both numbers are whole, so equal
similarities give equal ranks and the customer id decides.

Work per product is bounded. The customers of a product bought by at most ``max_pair_degree`` of them are listed and
paired (``_rare_only``): only ids and counts travel to the one customer of a pair who adds up what they share, and only pairs that
can reach a customer's k best go on. The more popular ones go through an inverted index with bound-driven prefixes
(``_popular_only``), which lists only what can still reach a customer's k best. No pair is left out: a
pair that also shares a rarer product comes from the join, with its popular part added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketwise.session import materialise

LEVELS = 12  # the highest class of thresholds: 1 - 4 ** -LEVELS and above
CELL_ROWS = 4096  # entries of one cell of the index that stay together
NEAR = 8  # most popular products whose weights go along with every entry
PAIRS = 1_000_000  # meetings of two customers in a product that one task adds up
AT_ONCE = 100_000_000  # meetings whose lists are moved at a time
_SLACK = 1 - 1e-9  # bounds are doubles, ranks are not


def purchase_matrix(retail: DataFrame) -> DataFrame:
    """Units bought per customer and product, as a long table."""
    return (
        retail.where(F.col("Customer ID").isNotNull() & F.col("StockCode").isNotNull())
        .groupBy(F.col("Customer ID").alias("CustomerID"), "StockCode")
        .agg(F.sum("Quantity").alias("PurchaseCount"))
        .where("PurchaseCount > 0")
    )


def matrix_stats(matrix: DataFrame) -> DataFrame:
    counts = matrix.agg(
        F.count(F.lit(1)).alias("interactions"),
        F.count_distinct("CustomerID").alias("customers"),
        F.count_distinct("StockCode").alias("products"),
    )
    cells = F.nullif(F.col("customers") * F.col("products"), F.lit(0).cast("long"))
    return counts.withColumn("density_pct", F.col("interactions") / cells * 100)


def _rank_key(dot: Column, length2: Column) -> Column:
    squared = dot.cast("double") * dot.cast("double")
    return squared / length2.cast("double")


def _best(pairs: DataFrame, k: int | None, by: str = "a", other: str = "b") -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc(_rank_key(F.col("dot"), F.col("n2b"))), other)
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def _mirrored(pairs: DataFrame) -> DataFrame:
    """Pairs a < b in both directions."""
    there = F.struct("a", "b", "n2a", "n2b")
    back = F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("n2b").alias("n2a"), F.col("n2a").alias("n2b"))
    return pairs.select(F.explode(F.array(there, back)).alias("p"), "dot").select("p.*", "dot")


def _shared(left: DataFrame, right: DataFrame, both_ways: bool) -> DataFrame:
    """Dot products over the products two customers share, one row per pair."""
    a = left.select("StockCode", F.col("CustomerID").alias("a"), F.col("n2").alias("n2a"), F.col("q").alias("qa"))
    b = right.select("StockCode", F.col("CustomerID").alias("b"), F.col("n2").alias("n2b"), F.col("q").alias("qb"))
    distinct = F.col("a") != F.col("b") if both_ways else F.col("a") < F.col("b")
    return (
        a.join(b, "StockCode")
        .where(distinct)
        .groupBy("a", "b", "n2a", "n2b")
        .agg(F.sum(F.col("qa") * F.col("qb")).alias("dot"))
    )


def _buyers(rare: DataFrame, *more: str) -> DataFrame:
    """(StockCode, buyers) of products somebody who asks has: c, q, n2 and ``more`` of each customer, those who ask first."""
    one = F.struct((~F.col("asks")).alias("later"), F.col("CustomerID").alias("c"), "q", "n2", *more)
    lists = rare.groupBy("StockCode").agg(F.sort_array(F.collect_list(one)).alias("buyers"))
    return lists.where(~F.col("buyers")[0]["later"])


def _thresholds(rare: DataFrame, k: int) -> DataFrame:
    """(a, t): a key that k others of an asking customer reach at least; none where too few are found.

    Each of a customer's products offers those who weigh it most. What two share besides can only add to their key.
    """
    sizes = rare.where("asks").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("CustomerID").alias("m")).first()
    most = min(k, -(-3 * k * sizes["m"] // max(sizes["n"], 1)))  # three times k in a list of mean length
    by_weight = F.transform("buyers", lambda b: F.struct((b["q"].cast("double") * b["q"] / b["n2"]).alias("w"), b["c"].alias("c"), b["q"].alias("q"), b["n2"].alias("n2")))
    lead = F.slice(F.sort_array(by_weight, asc=False), 1, most + 1)
    asked = _buyers(rare).withColumn("lead", lead).select(F.explode(F.filter("buyers", lambda b: ~b["later"])).alias("x"), "lead")
    others = F.slice(F.filter("lead", lambda y: y["c"] != F.col("x.c")), 1, most)
    offered = asked.select(F.col("x.c").alias("a"), F.col("x.q").alias("qa"), F.explode(others).alias("y"))
    keyed = offered.select("a", F.col("y.c").alias("b"), _rank_key(F.col("qa") * F.col("y.q"), F.col("y.n2")).alias("key"))
    best = keyed.repartition("a").groupBy("a", "b").agg(F.max("key").alias("key"))
    order = Window.partitionBy("a").orderBy(F.desc("key"))
    return best.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select("a", F.col("key").alias("t"))


def _narrow(rows: DataFrame, column: str) -> str:
    """The narrowest type that holds a column's whole numbers; other columns keep theirs."""
    own = rows.schema[column].dataType.simpleString()
    if own not in ("bigint", "int"):
        return own
    low, high = rows.agg(F.min(column), F.max(column)).first()
    bits = max(-(low or 0) - 1, high or 0, 0).bit_length()
    return "smallint" if bits < 16 else "int" if bits < 32 else own


class Packed:
    """Puts a key and a count into one element of an array, and takes them out again.

    Whole numbers without nulls, the counts not negative, go into one number of the narrowest type that holds all of ``rows``; others
    become a struct of the narrowest types.
    """

    def __init__(self, rows: DataFrame, key: str, count: str) -> None:
        self.types = types = [rows.schema[c].dataType.simpleString() for c in (key, count)]
        self.bits, self.type = 0, None
        if set(types) <= {"bigint", "int", "smallint", "tinyint"}:
            ends = rows.agg(*[f(c) for c in (key, count) for f in (F.min, F.max)], F.count_if(F.col(key).isNull() | F.col(count).isNull())).first()
            low, high, least, most, nulls = (x or 0 for x in ends)
            bits = most.bit_length()
            size = max(low, ~low, high, ~high).bit_length() + bits
            if not nulls and least >= 0 and size < 64:
                self.bits, self.type = bits, "int" if size < 32 else "bigint"
        if self.type is None:
            self.narrow = [_narrow(rows, c) for c in (key, count)]

    def put(self, key: Column, count: Column) -> Column:
        if self.type is None:
            return F.struct(key.cast(self.narrow[0]).alias("key"), count.cast(self.narrow[1]).alias("count"))
        return F.shiftleft(key.cast("bigint"), self.bits).bitwiseOR(count.cast("bigint")).cast(self.type)

    def key(self, element: Column) -> Column:
        return (element["key"] if self.type is None else F.shiftright(element, self.bits)).cast(self.types[0])

    def count(self, element: Column) -> Column:
        return (element["count"] if self.type is None else element.bitwiseAND(F.lit((1 << self.bits) - 1).cast(self.type))).cast(self.types[1])


def _rare_only(rare: DataFrame, k: int) -> DataFrame:
    """Candidates (a, b, n2a, n2b, dot), at least the k best of each asking customer, where all products have few buyers.

    A pair that shares one product is settled where the product's customers are listed. Those that share more are met at the
    customer who comes first in these lists: they get ids and counts of all who come later, and add up. Only
    pairs met twice get the other's length, and only candidates that reach a threshold are left.

    Args:
        rare: CustomerID, StockCode, q (positive), n2, degree, asks.
    """
    found = materialise(_thresholds(rare, k), "thresholds")
    owner = found.withColumnRenamed("a", "CustomerID")
    lists = materialise(_buyers(rare.join(owner, "CustomerID", "left").withColumn("t", F.coalesce("t", F.lit(0.0))), "t"), "buyers")
    reach = lambda x, y: (x["c"] != y["c"]) & (_rank_key(x["q"] * y["q"], y["n2"]) >= x["t"])
    once = lists.select(F.explode(F.filter("buyers", lambda x: ~x["later"])).alias("x"), "buyers")
    once = once.select("x", F.explode(F.filter("buyers", lambda y: reach(F.col("x"), y))).alias("y"))
    once = once.select(F.col("x.c").alias("a"), F.col("y.c").alias("b"), F.col("x.n2").alias("n2a"), F.col("y.n2").alias("n2b"), (F.col("x.q") * F.col("y.q")).alias("dot"))

    # what is known of each customer: the length, and the threshold of those who ask
    known = rare.groupBy("CustomerID").agg(F.max("n2").alias("n2"), F.max("asks").alias("asks")).join(owner, "CustomerID", "left")
    known = materialise(known.select("CustomerID", "n2", F.when(F.col("asks"), F.coalesce("t", F.lit(0.0))).alias("t")), "lengths")

    meetings = rare.select("StockCode", "degree").distinct().agg(F.sum(F.col("degree") * F.col("degree") / 2)).first()[0] or 0
    parts = int(meetings // AT_ONCE) + 1
    tasks = max(int(rare.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(meetings // parts // PAIRS) + 1)
    pack = Packed(rare, "CustomerID", "q")  # these lists are most of what is moved
    packed = F.transform("buyers", lambda y: pack.put(y["c"], y["q"])).alias("cq")
    sent = lists.select("buyers", packed).select(F.posexplode("buyers").alias("pos", "x"), "cq").where("NOT x.later AND pos + 1 < size(cq)")
    for part in range(parts):
        mine = sent.where(F.pmod(F.xxhash64("x.c"), F.lit(parts)) == part)
        mine = mine.select(F.col("x.c").alias("a"), F.col("x.q").alias("qa"), F.slice("cq", F.col("pos") + 2, F.size("cq")).alias("cq")).repartition(tasks, "a")
        met = mine.select("a", "qa", F.explode("cq").alias("y")).groupBy("a", pack.key(F.col("y")).alias("b"))
        many = met.agg(F.sum(F.col("qa") * pack.count(F.col("y"))).alias("dot"), F.count(F.lit(1)).alias("n")).where("n > 1 AND a <> b").drop("n")
        for side in "ab":
            many = many.join(known.select(*[F.col(c).alias(n) for c, n in (("CustomerID", side), ("n2", f"n2{side}"), ("t", f"t{side}"))]), side)
        # written one after another, so that the lists of one part alone are on disk
        once = once.unionByName(materialise(_mirrored_within(many), "met"))
    return once.repartition("a").groupBy("a", "b", "n2a", "n2b").agg(F.max("dot").alias("dot"))


def _mirrored_within(pairs: DataFrame) -> DataFrame:
    """Pairs in those directions in which they reach the threshold of the one who asks."""
    there = F.struct("a", "b", "n2a", "n2b", F.col("ta").alias("t"))
    back = F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("n2b").alias("n2a"), F.col("n2a").alias("n2b"), F.col("tb").alias("t"))
    both = pairs.select(F.explode(F.array(there, back)).alias("p"), "dot").select("p.*", "dot")
    return both.where(_rank_key(F.col("dot"), F.col("n2b")) >= F.col("t")).drop("t")


def _all_pairs(entries: DataFrame, block: int) -> DataFrame:
    """All pairs (a, b, n2a, n2b, dot) of an asking customer and another one that share a product.

    The buyers of a product are listed in blocks of about ``block``, by hash, so no row holds all buyers of a popular one. Each asking buyer
    gets the blocks, and adds up who is met in several lists: ids, lengths and counts travel, in one number, but no pairs.

    Args:
        entries: CustomerID, StockCode, q (positive), n2, degree, asks.
    """
    name = Packed(entries, "CustomerID", "n2")
    named = entries.withColumn("name", name.put(F.col("CustomerID"), F.col("n2")))
    pack = Packed(named, "name", "q")
    dealt = named.withColumn("parts", F.ceil(F.col("degree") / F.lit(max(block, 1))).cast("int"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("CustomerID"), F.col("parts")).cast("int")).withColumn("e", pack.put(F.col("name"), F.col("q")))
    lists = dealt.groupBy("StockCode", "parts", "part").agg(F.collect_list("e").alias("others"), F.collect_list(F.when(F.col("asks"), F.col("e"))).alias("askers"))
    lists = materialise(lists, "buyers")
    once = lists.where("parts = 1").select(F.explode("askers").alias("x"), "others")
    many = lists.where("parts > 1")
    asked = many.select("StockCode", "parts", F.explode("askers").alias("x")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = once.unionByName(asked.join(many.select("StockCode", "part", "others"), ["StockCode", "part"]).select("x", "others"))

    meetings = entries.where("asks").agg(F.sum("degree")).first()[0] or 0
    tasks = max(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(meetings) // PAIRS + 1)
    own = pack.key(F.col("x"))
    sent = met.select(name.key(own).alias("a"), name.count(own).alias("n2a"), pack.count(F.col("x")).alias("qa"), "others").repartition(tasks, "a")
    rows = sent.select("a", "n2a", "qa", F.explode("others").alias("y")).groupBy("a", "n2a", pack.key(F.col("y")).alias("y"))
    pairs = rows.agg(F.sum(F.col("qa") * pack.count(F.col("y"))).alias("dot"))
    return pairs.select("a", name.key(F.col("y")).alias("b"), "n2a", name.count(F.col("y")).alias("n2b"), "dot").where("a <> b")


def _asking(rows: DataFrame, customers: DataFrame) -> DataFrame:
    asked = customers.select("CustomerID", F.lit(True).alias("asks")).distinct()
    return rows.join(asked, "CustomerID", "left").withColumn("asks", F.coalesce("asks", F.lit(False)))


def _add_popular(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Add the popular products' share to the dot products of known pairs."""
    a = left.select(F.col("CustomerID").alias("a"), "StockCode", F.col("q").alias("qa"))
    b = right.select(F.col("CustomerID").alias("b"), "StockCode", F.col("q").alias("qb"))
    extra = (
        pairs.select("a", "b", "n2a", "n2b").join(a, "a").join(b, ["b", "StockCode"])
        .select("a", "b", "n2a", "n2b", (F.col("qa") * F.col("qb")).alias("dot"))
    )
    return pairs.unionByName(extra).groupBy("a", "b", "n2a", "n2b").agg(F.sum("dot").alias("dot"))


def _with_rest(rows: DataFrame, owner: str) -> DataFrame:
    """Adds ``rest``, the length of what follows an entry in its owner's list, and ``ahead``, with the entry itself."""
    later = Window.partitionBy(owner).orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    squares = F.coalesce(F.sum(F.col("x") * F.col("x")).over(later), F.lit(0.0))
    return rows.withColumn("rest2", squares).select("*", F.sqrt("rest2").alias("rest"), F.sqrt(F.col("rest2") + F.col("x") * F.col("x")).alias("ahead")).drop("rest2")


def _nearby(members: DataFrame, k: int) -> DataFrame:
    """(basket, b, n2b): some members that are likely near a basket, to start from. What is found here only sets thresholds.

    Members are laid out twice, by the product they hold most of and by their most popular one, and within each by their other
    products and weights. A layout's part holds about ``CELL_ROWS`` members of a product, dealt by hash if it has more.
    """
    largest = F.array_max(F.transform("items", lambda i: F.struct(i["q"].alias("q"), i["StockCode"].alias("StockCode"))))
    shapes = {
        "most": (largest["StockCode"], largest["q"] / F.sqrt("n2")),
        "last": (F.element_at("items", -1)["StockCode"], F.element_at("items", -1)["q"] / F.sqrt("n2")),
    }
    found = None
    for code, weight in shapes.values():
        laid = members.select("basket", "b", "n2", code.alias("code"), weight.alias("weight"), F.transform("items", lambda i: i["StockCode"]).alias("codes"))
        many = laid.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("parts"))
        laid = laid.join(many, "code").withColumn("part", F.pmod(F.xxhash64("basket"), F.col("parts")))
        around = Window.partitionBy("code", "part").orderBy("codes", "weight", "basket", "n2", "b")
        ahead = around.rowsBetween(-(k + 1), k + 1)
        seen = laid.withColumn("m", F.collect_list(F.struct("b", F.col("n2").alias("n2b"))).over(ahead))
        pairs = seen.select("basket", F.explode("m").alias("m"))
        found = pairs if found is None else found.unionByName(pairs)
    return found.select("basket", "m.b", "m.n2b").distinct()


def _basket_dots(pairs: DataFrame, queries: DataFrame, entries: DataFrame) -> DataFrame:
    """(basket, b, n2b, dot) of every pair (basket, b, n2b)."""
    asked = pairs.join(queries.select("basket", "StockCode", F.col("q").alias("qa")), "basket")
    both = asked.join(entries.select("b", "StockCode", F.col("q").alias("qb")), ["b", "StockCode"])
    return both.groupBy("basket", "b", "n2b").agg(F.sum(F.col("qa") * F.col("qb")).alias("dot"))


def _kth_key(pairs: DataFrame, by: str, k: int) -> DataFrame:
    """(by, key) of the k-th best of each, where there is one."""
    order = Window.partitionBy(by).orderBy(F.desc("key"))
    keyed = pairs.select(by, _rank_key(F.col("dot"), F.col("n2b")).alias("key"))
    return keyed.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select(by, "key")


def _numbered(side: str) -> list[Column]:
    return [F.col("near")[i].alias(f"{side}{i}") for i in range(NEAR)] + [F.col("away").alias(f"{side}{NEAR}")]


def _met(queries: DataFrame, entries: DataFrame) -> DataFrame:
    """(basket, b, n2b) that can reach the basket's threshold by popular products.

    queries: basket, t, StockCode, x, rest, ahead, near, away; entries: b, n2b, StockCode, x, rest, ahead, near, away. Both are
    listed by rising degree. The first product that two lists share is where both still have at least t ahead of them; there
    their parts allow at most ``x * x' + rest * rest'``. So do the weights of the most popular products (``near``) and the
    length of all others (``away``). Vectors at cosine t are at most sqrt(2 - 2 t) apart in each product: thresholds are put
    into classes, and the index into cells of the class's width, by the shared product and the two most popular ones. Cells
    with very many entries are dealt by hash.
    """
    level = F.least(F.floor(-F.log2(F.greatest(1 - F.col("t"), F.lit(4.0 ** -(LEVELS + 1)))) / 2), F.lit(LEVELS)).cast("int")
    queries = queries.where(F.col("ahead") >= F.col("t") * _SLACK).withColumn("level", level)
    levels = F.broadcast(queries.select("level").distinct())  # at most LEVELS + 1
    apart = F.sqrt(2 * F.pow(F.lit(4.0), -F.col("level"))) + 1e-9
    keys = ["level", "StockCode", "c0", "c1", "c2"]
    sides = {"c0": F.col("x"), "c1": F.col("near")[0], "c2": F.col("near")[1]}
    cell = lambda value: F.floor(value / (2 * F.col("apart"))).cast("int")
    index = entries.join(levels, F.col("ahead") >= (1 - F.pow(F.lit(4.0), -F.col("level"))) * _SLACK).withColumn("apart", apart)
    index = index.select(*keys[:2], *[cell(v).alias(c) for c, v in sides.items()], "b", "n2b", F.col("x").alias("xb"), F.col("rest").alias("rest_b"), *_numbered("b"))
    asking = queries.withColumn("apart", apart)
    for c, v in sides.items():
        asking = asking.withColumn(c, F.explode(F.sequence(cell(v - F.col("apart")), cell(v + F.col("apart")))))
    asking = asking.select(*keys, "basket", "t", "x", "rest", *_numbered("a"))
    full = index.groupBy(keys).agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("parts")).where("parts > 1")
    index = index.join(full, keys, "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    asking = asking.join(full, keys, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    parts = [F.col(f"a{i}") * F.col(f"b{i}") for i in range(NEAR + 1)]
    possible = F.least(F.col("x") * F.col("xb") + F.col("rest") * F.col("rest_b"), sum(parts[1:], parts[0])) >= F.col("t") * _SLACK
    return asking.join(index, [*keys, "salt"]).where(possible).select("basket", "b", "n2b").distinct()


def _popular_only(asking: DataFrame, owned: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """Candidates by popular products alone, at least the k best of each customer.

    Among customers with one popular basket the similarity to any other customer with whom nothing else is shared depends
    on the other's length alone. So a basket asks once, and offers its ``k + 1`` shortest customers (ties by id).

    Args:
        asking, owned: CustomerID, n2, StockCode, q, degree of popular products, of those who ask and of all.
        known: pairs found so far, whose k-th best of each customer is a threshold.
    """

    def baskets(rows: DataFrame) -> DataFrame:
        # a basket holds at most the popular products of one customer, the least popular first
        return rows.groupBy("CustomerID", "n2").agg(F.sort_array(F.collect_list(F.struct("degree", "StockCode", "q"))).alias("items"))

    owners = materialise(baskets(owned), "popular-baskets")
    askers = owners if asking is owned else baskets(asking)
    shortest = Window.partitionBy("items").orderBy("n2", "CustomerID")
    kept = owners.withColumn("_n", F.row_number().over(shortest)).where(F.col("_n") <= k + 1)
    named = materialise(kept.where("_n = 1").select("items", F.monotonically_increasing_id().alias("basket")), "basket-names")
    members = materialise(kept.join(named, "items").select("basket", F.col("CustomerID").alias("b"), "n2", "items"), "basket-members")
    askers = materialise(askers.join(named, "items").select("basket", F.col("CustomerID").alias("a"), F.col("n2").alias("n2a")), "basket-askers")

    # the most popular products: coordinates that all entries carry
    top = [r[0] for r in owned.select("StockCode", "degree").distinct().orderBy(F.desc("degree"), "StockCode").limit(NEAR).collect()]
    units = lambda code: F.coalesce(F.get(F.filter("items", lambda i: i["StockCode"] == F.lit(code)), 0)["q"], F.lit(0).cast("long"))
    padded = [units(code) for code in top] + [F.lit(0).cast("long")] * (NEAR - len(top))
    own2 = F.aggregate("items", F.lit(0).cast("long"), lambda s, i: s + i["q"] * i["q"])
    vectors = lambda rows: rows.withColumn("units", F.array(*padded)).withColumn("own2", own2)
    near2 = F.aggregate("units", F.lit(0).cast("long"), lambda s, q: s + q * q)
    weights = lambda length: [
        F.transform("units", lambda q: q / F.sqrt(length)).alias("near"), F.sqrt((F.col("own2") - near2) / F.col(length)).alias("away")
    ]
    listed = F.posexplode("items").alias("pos", "i")
    entries = vectors(members).select("b", F.col("n2").alias("n2b"), *weights("n2"), listed)
    entries = entries.select("b", "n2b", "near", "away", "pos", "i.StockCode", "i.q", (F.col("i.q") / F.sqrt("n2b")).alias("x"))
    entries = materialise(_with_rest(entries, "b"), "popular-entries")
    asked = named.join(askers.select("basket").distinct(), "basket", "left_semi")
    queries = vectors(asked).select("basket", F.col("own2").alias("length2"), *weights("own2"), listed)
    queries = queries.select("basket", "length2", "near", "away", "pos", "i.StockCode", "i.q", (F.col("i.q") / F.sqrt("length2")).alias("x"))
    queries = materialise(_with_rest(queries, "basket"), "popular-queries")

    first = materialise(_basket_dots(_nearby(members, k).join(asked.select("basket"), "basket", "left_semi"), queries, entries), "popular-nearby")
    # one of the k + 1 best of a basket may be the asking customer itself
    own = _kth_key(first, "basket", k + 1).withColumnRenamed("key", "own")
    joined = _kth_key(known, "a", k).join(askers.select("a", "basket"), "a", "right")
    joined = joined.groupBy("basket").agg(F.min(F.coalesce("key", F.lit(0.0))).alias("joined"))
    least = joined.join(own, "basket", "left").select("basket", F.greatest("joined", F.coalesce("own", F.lit(0.0))).alias("key"))
    bounded = queries.join(least, "basket").withColumn("t", F.sqrt(F.col("key") / F.col("length2"))).where(F.col("t") <= 1 / _SLACK)
    pairs = _met(bounded, entries)
    dots = first.unionByName(_basket_dots(pairs, queries, entries)).groupBy("basket", "b", "n2b").agg(F.max("dot").alias("dot"))
    best = materialise(_best(dots, k + 1, by="basket").drop("rank"), "popular-best")
    return askers.join(best, "basket").where(F.col("a") != F.col("b")).select("a", "b", "n2a", "n2b", "dot")


def nearest_customers(
    matrix: DataFrame, k: int | None = 10, customers: DataFrame | None = None, max_pair_degree: int = 1000
) -> DataFrame:
    """The k most similar other customers of every customer, or of the given ones; all of them without ``k``.

    Gives (CustomerID, neighbour, similarity, rank); customers that share no product are no
    neighbours. ``max_pair_degree`` decides how a product is treated, never what the result is.
    """
    entries = matrix.select("CustomerID", "StockCode", F.col("PurchaseCount").cast("long").alias("q"))
    lengths = entries.groupBy("CustomerID").agg(F.sum(F.col("q") * F.col("q")).alias("n2"))
    buyers = entries.groupBy("StockCode").agg(F.count(F.lit(1)).alias("degree"))
    tagged = materialise(
        entries.join(lengths, "CustomerID").join(buyers, "StockCode")
        .withColumn("popular", F.col("degree") > max_pair_degree),
        "matrix",
    )
    if k is None:
        pairs = _all_pairs(tagged.withColumn("asks", F.lit(True)) if customers is None else _asking(tagged, customers), max_pair_degree)
        return _named(_best(pairs, k))
    asking = tagged if customers is None else tagged.join(customers.select("CustomerID").distinct(), "CustomerID", "left_semi")
    rare, rare_asking = tagged.where("NOT popular"), asking.where("NOT popular")
    popular, popular_asking = tagged.where("popular"), asking.where("popular")
    if popular.isEmpty():
        pairs = _rare_only(rare.withColumn("asks", F.lit(True)) if customers is None else _asking(rare, customers), k)
    else:
        pairs = _add_popular(_shared(rare_asking, rare, both_ways=customers is not None), popular_asking, popular)
        if customers is None:
            pairs = _mirrored(pairs)
        pairs = materialise(pairs, "rare-pairs")
        only = _popular_only(popular if customers is None else popular_asking, popular, pairs, k)
        # a pair found both ways has its full dot product from the join, which is the larger one
        pairs = pairs.unionByName(only).groupBy("a", "b", "n2a", "n2b").agg(F.max("dot").alias("dot"))
    return _named(_best(pairs, k))


def _named(best: DataFrame) -> DataFrame:
    return best.select(
        F.col("a").alias("CustomerID"),
        F.col("b").alias("neighbour"),
        (F.col("dot").cast("double") / (F.sqrt(F.col("n2a").cast("double")) * F.sqrt(F.col("n2b").cast("double")))).alias("similarity"),
        "rank",
    )


def mean_similarity(neighbours: DataFrame, customers: DataFrame, matrix: DataFrame, top: int = 5) -> DataFrame:
    """Mean over the given customers of the mean similarity of their ``top`` nearest customers.

    Customers that share nothing count as neighbours of similarity 0 where there are too few others.
    """
    others = matrix.agg(F.least(F.lit(top), F.count_distinct("CustomerID") - 1).alias("n")).scalar()
    near = neighbours.where(F.col("rank") <= top)
    scaled = F.rint(F.coalesce("similarity", F.lit(0.0)) * 1e12).cast("long")
    return (
        customers.join(near, "CustomerID", "left")
        .agg((F.sum(scaled) / F.lit(1e12)).alias("s"), F.count_distinct("CustomerID").alias("m"))
        .select((F.col("s") / F.nullif(F.col("m") * others, F.lit(0).cast("long"))).alias("avg_similarity"))
    )
