"""Customers linked by shared devices and IP addresses.

The links of an entity form a star around its least customer. A star has as many edges as the
entity has other customers and connects the same customers as all pairs would, so an address
shared by millions of customers stays linear.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from riskframe.operators.skew import splittable
from riskframe.session import staged, work_path


def _usage(customer_devices: DataFrame, customer_ips: DataFrame) -> DataFrame:
    columns = lambda df, kind, key: df.select("customer_id", F.lit(kind).alias("kind"), F.col(key).alias("entity"))
    pairs = columns(customer_devices, "device", "device_id").unionByName(columns(customer_ips, "ip", "ip_address"))
    return pairs.filter(F.col("customer_id").isNotNull() & F.col("entity").isNotNull()).distinct()


def shared_entity_edges(customer_devices: DataFrame, customer_ips: DataFrame) -> DataFrame:
    """Star edges (hub, customer_id) with the number of devices and IPs that link the two."""
    usage = _usage(customer_devices, customer_ips)
    hubs = usage.groupBy("kind", "entity").agg(F.min("customer_id").alias("hub"), F.count(F.lit(1)).alias("n"))
    return (
        usage.join(splittable(hubs.filter("n > 1")), ["kind", "entity"])
        .filter("customer_id <> hub")
        .groupBy("hub", "customer_id")
        .agg(
            F.count_if(F.col("kind") == "device").alias("shared_devices"),
            F.count_if(F.col("kind") == "ip").alias("shared_ips"),
        )
    )


def customer_degrees(customer_devices: DataFrame, customer_ips: DataFrame) -> DataFrame:
    """Per customer: shared entities, and the sum of other customers on them."""
    usage = _usage(customer_devices, customer_ips)
    sizes = usage.groupBy("kind", "entity").agg(F.count(F.lit(1)).alias("n"))
    return (
        usage.join(splittable(sizes), ["kind", "entity"])
        .groupBy("customer_id")
        .agg(F.count_if(F.col("n") > 1).alias("shared_entities"), F.sum(F.col("n") - 1).alias("co_users"))
    )


#: Customers of an entity up to which its pairs are written out, and the size of a sketch (error about 1.6 %).
MOST_PAIRED, SKETCH_BITS = 50, 12


def _sized(usage: DataFrame) -> DataFrame:
    """Usage with ``n``, the customers of the entity."""
    sizes = usage.groupBy("kind", "entity").agg(F.count(F.lit(1)).alias("n"))
    return usage.join(splittable(sizes), ["kind", "entity"])


def _pairs(sized: DataFrame) -> DataFrame:
    """(kind, a, b) with a < b for each pair of customers on an entity; ``n`` must be bounded."""
    members = sized.filter("n > 1").groupBy("kind", "entity").agg(F.array_sort(F.collect_list("customer_id")).alias("_members"))
    later = lambda a: F.filter("_members", lambda b: b > a)
    paired = F.transform("_members", lambda a: F.transform(later(a), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    return members.select("kind", F.flatten(paired).alias("_pairs")).select("kind", F.inline("_pairs"))


def shared_entity_pairs(customer_devices: DataFrame, customer_ips: DataFrame, most: int = MOST_PAIRED) -> DataFrame:
    """(a, b, shared_devices, shared_ips) for customers a < b that share an entity of at most ``most`` customers.

    An entity adds at most most * (most - 1) / 2 rows. The pairs of larger ones are not written out; ``shared_entity_edges``
    connects their customers and ``customer_neighbours`` counts them. Null customers and entities link nothing.
    """
    bounded = _sized(_usage(customer_devices, customer_ips)).filter(F.col("n") <= most)
    return (
        _pairs(bounded)
        .groupBy("a", "b")
        .agg(
            F.count_if(F.col("kind") == "device").alias("shared_devices"),
            F.count_if(F.col("kind") == "ip").alias("shared_ips"),
        )
    )


def customer_neighbours(
    customer_devices: DataFrame, customer_ips: DataFrame, most: int = MOST_PAIRED, sketch_bits: int = SKETCH_BITS
) -> DataFrame:
    """(customer_id, neighbours, is_exact): different other customers on any of the customer's entities.

    A customer counts once, however many entities are shared. The number is exact for customers with one entity,
    of any size, and for those whose entities all have at most ``most`` customers. Others take the union of one sketch
    for each of their entities, of fixed size, so a popular address costs one row per customer and never its pairs.
    """
    sized = _sized(_usage(customer_devices, customer_ips))
    reach = sized.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_entities"), F.max("n").alias("_most"))
    by_pairs, by_sketch = F.col("_most") <= most, (F.col("_most") > most) & (F.col("_entities") > 1)

    pairs = _pairs(sized.filter(F.col("n") <= most)).select("a", "b").distinct()
    either = F.array(F.col("a"), F.col("b"))
    counted = pairs.select(F.explode(either).alias("customer_id")).groupBy("customer_id").agg(F.count(F.lit(1)).alias("_pairs"))

    wide = sized.join(splittable(reach.filter(by_sketch).select("customer_id")), "customer_id", "left_semi")
    asked = wide.select("kind", "entity").distinct()
    sketches = (
        sized.join(splittable(asked), ["kind", "entity"], "left_semi")
        .groupBy("kind", "entity")
        .agg(F.hll_sketch_agg("customer_id", F.lit(sketch_bits)).alias("_sketch"))
    )
    united = F.hll_sketch_estimate(F.hll_union_agg("_sketch"))
    estimated = wide.join(splittable(sketches), ["kind", "entity"]).groupBy("customer_id").agg(united.alias("_united"))

    joined = reach.join(splittable(counted), "customer_id", "left").join(splittable(estimated), "customer_id", "left")
    others = F.col("_most") - 1  # of the largest entity alone
    neighbours = (
        F.when(by_pairs, F.coalesce("_pairs", F.lit(0)))
        .when(by_sketch, F.greatest(F.col("_united") - 1, others))
        .otherwise(others)
    )
    return joined.select("customer_id", neighbours.cast("bigint").alias("neighbours"), (~by_sketch).alias("is_exact"))


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """(a, b, least): each edge with the least node of a's neighbourhood, a itself included.

    Minimum by aggregation, then a join: a hub's neighbourhood is never gathered in one task.
    """
    least = edges.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return edges.join(splittable(least), "a")


def _labels(stars: DataFrame) -> DataFrame:
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node is the center of its neighbours or has one edge, to a center, in ``edges`` with b < a."""
    ends = F.array(*[F.struct(F.col(c).alias("node"), F.lit(c == "a").alias("leaves")) for c in "ab"])
    counts = edges.select(F.inline(ends)).groupBy("node").agg(F.count_if("leaves").alias("out"), F.count_if(~F.col("leaves")).alias("into"))
    return counts.filter("out > 1 or out > 0 and into > 0").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for undirected ``edges`` (a, b); the component is its least node.

    Alternates large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce
    and Beyond", 2014), which needs a logarithmic number of rounds in practice. Each round is written
    to the shared folder: that cuts the lineage, survives lost executors, and delivers the
    convergence counters without another pass. It ends with a round that changes nothing; edges that are stars
    already need no round.
    """
    signature, folder = None, work_path(edges.sparkSession, "components")
    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    current = staged(current, f"{folder}/edges")
    if _are_stars(current):
        return _labels(current)
    for number in count():
        both = current.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        # Large star: a node's larger neighbours move to the least node around it.
        large = _least_neighbour(both).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        # Small star: the node and its smaller neighbours do.
        moved = F.array(F.struct(F.col("b").alias("a"), F.col("least").alias("b")), F.struct("a", F.col("least").alias("b")))
        small = _least_neighbour(large.distinct()).select(F.inline(moved)).filter("a <> b").distinct()
        seen = Observation()
        measured = small.observe(
            seen, F.count(F.lit(1)).alias("edges"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hash")
        )
        current = staged(measured, f"{folder}/{number % 2}")  # the table before last is free again
        latest = (seen.get["edges"], seen.get["hash"])
        if latest == signature:
            return _labels(current)
        signature = latest


def customer_components(customer_devices: DataFrame, customer_ips: DataFrame) -> DataFrame:
    """(customer_id, component_id, component_size) for every customer with a device or IP."""
    edges = shared_entity_edges(customer_devices, customer_ips)
    labels = connected_components(edges.select(F.col("hub").alias("a"), F.col("customer_id").alias("b")))
    customers = _usage(customer_devices, customer_ips).select("customer_id").distinct()
    member = customers.join(labels.withColumnRenamed("node", "customer_id"), "customer_id", "left").select(
        "customer_id", F.coalesce("component", "customer_id").alias("component_id")
    )
    sizes = member.groupBy("component_id").agg(F.count(F.lit(1)).alias("component_size"))
    return member.join(splittable(sizes), "component_id").select("customer_id", "component_id", "component_size")
