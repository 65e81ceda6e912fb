"""Relations over child-parent and spouse edges, ancestor closures, common ancestors and trees.

Edges are ``child_of(child, parent)`` and ``spouse_of(a, b)``; persons are
``persons(id, label, sex)``.  Everything runs for all egos at once.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import NAMES, hold, numbered, settle, small


def symmetric(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Both directions of each edge, once."""
    return edges.select(a, b).unionByName(edges.select(F.col(b).alias(a), F.col(a).alias(b))).distinct()


def siblings(child_of: DataFrame) -> DataFrame:
    """(id, sibling): children of a common parent."""
    other = child_of.withColumnRenamed("child", "sibling")
    return child_of.join(other, "parent").where("child <> sibling").select(F.col("child").alias("id"), "sibling").distinct()


def grandparents(child_of: DataFrame) -> DataFrame:
    up = child_of.select(F.col("child").alias("parent"), F.col("parent").alias("grandparent"))
    return child_of.join(up, "parent").select(F.col("child").alias("id"), "grandparent").distinct()


def grandchildren(child_of: DataFrame) -> DataFrame:
    return grandparents(child_of).select(F.col("grandparent").alias("id"), F.col("id").alias("grandchild"))


def inlaws(child_of: DataFrame, spouse_of: DataFrame) -> DataFrame:
    """(id, inlaw): parents of spouses that are not parents."""
    s = symmetric(spouse_of)
    up = child_of.select(F.col("child").alias("b"), F.col("parent").alias("inlaw"))
    own = child_of.select(F.col("child").alias("id"), F.col("parent").alias("inlaw"))
    return s.join(up, "b").select(F.col("a").alias("id"), "inlaw").distinct().join(own, ["id", "inlaw"], "left_anti")


def closure(start: DataFrame, child_of: DataFrame, depth: int | None, up: bool = True, few: bool = False) -> DataFrame:
    """``start(id)`` -> ``(id, rel, d)``: all within ``depth`` steps up (or down), or all without one, itself at 0, at the least distance.

    One join a level; a pair that was reached before is dropped, so diamonds do not multiply.
    ``few``: the edges are those near a few persons, and levels are kept in the plan.
    """
    step = child_of.select(F.col("child" if up else "parent").alias("rel"), F.col("parent" if up else "child").alias("to")).distinct()
    front = start.select("id").distinct().select("id", F.col("id").alias("rel"), F.lit(0).alias("d"))
    reached = front
    for d in count(1) if depth is None else range(1, depth + 1):
        front = front.select("id", "rel").join(step, "rel").select("id", F.col("to").alias("rel")).distinct().join(reached.select("id", "rel"), ["id", "rel"], "left_anti")
        front = hold(front.withColumn("d", F.lit(d)), "closure", few)
        if front.isEmpty():
            break
        reached = reached.unionByName(front)
    return reached


def all_ancestors(child_of: DataFrame, depth: int | None = None) -> DataFrame:
    """(id, rel, d): every person's ancestors and itself at 0, at the least distance.

    Distances double: a shortest way of more than 2^k steps is one of 2^k steps
    and a rest of at most as many, so depth n takes about log2(n) joins.
    """
    one = settle(child_of.select(F.col("child").alias("id"), F.col("parent").alias("rel")).distinct().withColumn("d", F.lit(1)), "ancestors")
    known, reach = one, 1
    while depth is None or reach < depth:
        far, rest = known.where(F.col("d") == reach).select("id", F.col("rel").alias("mid")), known.select(F.col("id").alias("mid"), "rel", F.col("d").alias("more"))
        new = far.join(rest, "mid").groupBy("id", "rel").agg((F.min("more") + reach).alias("d")).join(known.select("id", "rel"), ["id", "rel"], "left_anti")
        new = settle(new.where(F.col("id") != F.col("rel")) if depth is None else new.where((F.col("id") != F.col("rel")) & (F.col("d") <= depth)), "ancestors")
        if not new.limit(1).count():
            break
        known, reach = known.unionByName(new), 2 * reach
    selves = child_of.select(F.explode(F.array("child", "parent")).alias("id")).distinct()
    return known.where(F.col("id") != F.col("rel")).unionByName(selves.select("id", F.col("id").alias("rel"), F.lit(0).alias("d")))


def common_ancestors(pairs: DataFrame, child_of: DataFrame, persons: DataFrame, limit: int | None = 5, depth: int | None = 10, bulk: bool = False, few: bool = False) -> DataFrame:
    """``pairs(a, b)`` -> ``(a, b, ancestor_id, full_name, da, db, total_depth, rank)``, nearest first, at most ``limit`` for each pair.

    A person is its own ancestor at distance 0, so a = b gives itself first.
    Without a ``depth`` ancestors of all generations count.  For few pairs only
    their own ancestors are walked; ``bulk`` walks everyone's, a list for each
    person and generation.
    """
    if limit is not None and not 1 <= limit <= 20:
        raise ValueError("limit must be from 1 to 20")
    if bulk:
        return _common_in_bulk(pairs, child_of, persons, limit, depth)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    c = closure(ids, child_of, depth, few=few)
    up_a = c.select(F.col("id").alias("a"), F.col("rel").alias("ancestor_id"), F.col("d").alias("da"))
    up_b = c.select(F.col("id").alias("b"), F.col("rel").alias("ancestor_id"), F.col("d").alias("db"))
    rows = pairs.distinct().join(up_a, "a").join(up_b, ["b", "ancestor_id"]).withColumn("total_depth", F.col("da") + F.col("db"))
    w = Window.partitionBy("a", "b").orderBy("total_depth", "da", "db", "ancestor_id")
    rows = rows.withColumn("rank", F.row_number().over(w))
    rows = rows if limit is None else rows.where(F.col("rank") <= limit)
    names = persons.select(F.col("id").alias("ancestor_id"), F.col("label").alias("full_name"))
    return _ranked(rows.join(names, "ancestor_id", "left"), limit).select("a", "b", "ancestor_id", "full_name", "da", "db", "total_depth", "rank")


def _ranked(rows: DataFrame, limit: int | None) -> DataFrame:
    """Ranks of rows that have their names: an id that ``persons`` holds twice has two rows, which count as such."""
    w = Window.partitionBy("a", "b").orderBy("total_depth", "da", "db", "ancestor_id", "full_name")
    rows = rows.withColumn("rank", F.row_number().over(w))
    return rows if limit is None else rows.where(F.col("rank") <= limit)


#: Generations that are walked for everyone before the pairs that are settled by them are set aside.
NEAREST = 8

#: Generations after which a walk looks whether it still finds anybody, and pairs of persons in one task.
ROUNDS, PAIRS = 32, 8_000


def _ancestor_lists(edges: DataFrame, ids: DataFrame, depth: int | None) -> tuple[list[DataFrame], bool]:
    """``edges(child, parent)`` -> a table ``(id, d, up)`` for each generation, and whether they are all: who is ``d`` steps up, by whatever way.

    A list is made of the lists of the parents, so persons are joined once a
    generation, not ancestors.  Somebody may be in several lists of a person,
    the first of which gives the least distance; where ways go in circles, the
    walk ends when no list has anybody new.
    """
    lists = [ids.select("id", F.lit(0).alias("d"), F.array("id").alias("up"))]
    last, known = lists[0].drop("d"), None
    for d in count(1) if depth is None else range(1, depth + 1):
        last = edges.join(last.withColumnRenamed("id", "parent"), "parent").groupBy(F.col("child").alias("id")).agg(F.array_distinct(F.flatten(F.collect_list("up"))).alias("up"))
        last = settle(last, "ancestors")
        if last.isEmpty():
            return lists, True
        lists.append(last.select("id", F.lit(d).alias("d"), "up"))
        if d % ROUNDS == 0:
            now = reduce(DataFrame.unionByName, lists).select("id", F.explode("up").alias("rel")).distinct().count()
            if now == known:
                return lists, True
            known = now
    return lists, False


def _common_in_bulk(pairs: DataFrame, child_of: DataFrame, persons: DataFrame, limit: int | None, depth: int | None) -> DataFrame:
    """``common_ancestors`` of many pairs, over numbers in the order of ids.

    Both lists of a pair meet in one task.  With a ``limit``, only NEAREST
    generations are walked for everyone: an ancestor beyond them is farther than
    those found, once as many as asked for lie within so many steps in all.  The
    pairs that this does not settle are walked by themselves.
    """
    pairs = settle(pairs.select("a", "b").distinct(), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(child_of.select(F.explode(F.array("child", "parent")).alias("id")))
    known = numbered(ids.where("id is not null"), "id")
    code = lambda df, c: df.join(known.select(F.col("id").alias(c), F.col("code").alias(f"_{c}")), c)
    edges = settle(code(code(child_of.select("child", "parent").distinct(), "child"), "parent").select(F.col("_child").alias("child"), F.col("_parent").alias("parent")), "edges")
    key = F.shiftleft(F.col("_a").cast("long"), 32).bitwiseOR(F.col("_b").cast("long"))
    asked = settle(code(code(pairs, "a"), "b").select("a", "b", "_a", "_b", key.alias("key")), "asked")
    within = NEAREST if limit is not None and (depth is None or depth > NEAREST) else depth
    lists, whole = _ancestor_lists(edges, known.select(F.col("code").alias("id")), within)
    parts = max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-asked.count() // PAIRS))
    side = lambda c, mark: asked.select(F.col(c).alias("id"), "key", F.lit(mark).alias("first"))
    met = reduce(DataFrame.unionByName, lists).join(side("_a", True).unionByName(side("_b", False)), "id").select("key", "first", "d", "up").repartition(parts, "key")
    met = met.select("key", F.when(F.col("first"), F.col("d")).alias("da"), F.when(~F.col("first"), F.col("d")).alias("db"), F.explode("up").alias("rel"))
    met = met.groupBy("key", "rel").agg(F.min("da").alias("da"), F.min("db").alias("db")).where("da is not null and db is not null")
    columns = ("a", "b", "ancestor_id", "full_name", "da", "db", "total_depth", "rank")
    rest = None
    if limit is None:
        rows = met
    else:
        # total, da and the ancestor as one number, in the order of ranks
        order = F.expr("shiftleft(cast(da + db AS long), 46) | shiftleft(cast(da AS long), 32) | cast(rel AS long)") if len(lists) < 1 << 12 else F.struct(F.expr("da + db"), "da", "rel")
        if limit == 1:
            best = met.groupBy("key").agg(F.min(F.struct(order.alias("o"), "rel", "da", "db") if len(lists) >= 1 << 12 else order).alias("o"))
            rows = best.select("key", "o.rel", "o.da", "o.db") if len(lists) >= 1 << 12 else best.selectExpr("key", "cast(o & 4294967295 AS int) rel", "cast(shiftright(o, 32) & 16383 AS int) da", "cast(shiftright(o, 46) AS int) - cast(shiftright(o, 32) & 16383 AS int) db")
            rows = rows.withColumn("rank", F.lit(1))
        else:
            rows = met.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(order))).where(F.col("rank") <= limit)
        if not whole and within != depth:
            rows = settle(rows, "nearest")
            done = rows.where((F.col("rank") == limit) & (F.col("da") + F.col("db") <= within)).select("key")
            deep = lists[-1].select("id")  # all others have no ancestor farther up
            open_ = asked.join(done, "key", "left_anti")
            far = open_.join(deep.withColumnRenamed("id", "_a"), "_a", "left_semi").select("key", "a", "b").unionByName(open_.join(deep.withColumnRenamed("id", "_b"), "_b", "left_semi").select("key", "a", "b"))
            far = settle(far.distinct(), "far")
            rows = rows.join(far, "key", "left_anti")
            rest = far.select("a", "b")
            rest = None if rest.isEmpty() else rest
    names = known.select(F.col("code").alias("rel"), F.col("id").alias("ancestor_id")).join(persons.select(F.col("id").alias("ancestor_id"), F.col("label").alias("full_name")), "ancestor_id", "left")
    names = settle(names, "names")
    twice = limit is not None and names.count() > known.count()
    names = small(names, NAMES)
    rows = rows.join(asked.select("key", "a", "b").hint("shuffle_hash"), "key").drop("key").join(names, "rel")
    rows = rows.withColumn("total_depth", F.col("da") + F.col("db")).withColumn("rank", F.col("rank") if limit is not None else F.lit(None).cast("int")).select(*columns)
    rows = _ranked(rows, limit).select(*columns) if twice else rows
    if rest is not None:
        rows = rows.unionByName(common_ancestors(rest, child_of, persons, limit, depth))
    return rows


def check_depth(depth: int, most: int = 5) -> int:
    if not 1 <= depth <= most:
        raise ValueError(f"depth must be from 1 to {most}")
    return depth


def induced_edges(nodes: DataFrame, child_of: DataFrame, spouse_of: DataFrame) -> DataFrame:
    """``nodes(ego, id)`` -> ``(ego, source, target, type)``: edges with both ends in the set of an ego, spouse pairs once."""
    src = nodes.select("ego", F.col("id").alias("source")).distinct()
    dst = nodes.select("ego", F.col("id").alias("target")).distinct()
    kids = child_of.select(F.col("child").alias("source"), F.col("parent").alias("target"), F.lit("CHILD_OF").alias("type"))
    pairs = symmetric(spouse_of).where("a < b").select(F.col("a").alias("source"), F.col("b").alias("target"), F.lit("SPOUSE_OF").alias("type"))
    edges = kids.unionByName(pairs).distinct()
    return src.join(edges, "source").join(dst, ["ego", "target"], "left_semi").select("ego", "source", "target", "type")


def _by_sex(m: str, f: str, else_: str):
    sex = F.upper("sex")
    return F.when(sex == "M", m).when(sex == "F", f).otherwise(else_)


def five_tier_nodes(egos: DataFrame, persons: DataFrame, child_of: DataFrame, spouse_of: DataFrame, depth: int = 3, few: bool = False) -> DataFrame:
    """``egos(id)`` -> ``(ego, id, label, sex, kin)``: spouses, siblings, up to two generations up and down, with full kin labels."""
    hops = min(2, check_depth(depth) - 1)
    e = egos.join(persons.select("id"), "id", "left_semi").distinct()
    e = settle(e, "egos") if not few else e
    up = child_of.select(F.col("child").alias("id"), F.col("parent").alias("to")).distinct()
    down = up.select(F.col("to").alias("id"), F.col("id").alias("to"))
    then = lambda df, more: df.select("ego", F.col("to").alias("id")).join(more, "id").select("ego", "to")
    start = e.select(F.col("id").alias("ego"), F.col("id").alias("to"))
    parents, children = then(start, up), then(start, down)
    sexes = persons.select(F.col("id").alias("to"), F.upper("sex").alias("s"))
    via = parents.join(sexes, "to").where("s in ('M', 'F')").groupBy("ego", "s").agg(F.min("to").alias("to"))
    sides = via.select("ego", "s", F.col("to").alias("id")).join(up, "id").select("ego", "s", "to")
    # every way to be in a tree is a row with the order of its term, the first of which holds; a row that only gives a term shows nobody
    row = lambda df, o, shown=True: df.select("ego", F.col("to").alias("id"), (F.lit(o) if isinstance(o, int) else o).alias("o"), F.lit(shown).alias("shown"))
    ways = [
        row(start, 0),
        row(then(start, symmetric(spouse_of).select(F.col("a").alias("id"), F.col("b").alias("to"))), 1),
        row(parents, 2, hops >= 1),
        row(children, 3, hops >= 1),
        row(then(parents, down).where("to <> ego"), 4),
        row(sides, F.when(F.col("s") == "M", 5).otherwise(6), hops >= 2),
        row(then(children, down), 7, hops >= 2),
    ]
    if hops >= 2:  # of several fathers or mothers one is the side's: the parents of the others have no term
        ways.append(row(then(parents, up), 8))
    node = reduce(DataFrame.unionByName, ways).groupBy("ego", "id").agg(F.min("o").alias("o"), F.max("shown").alias("shown")).where("shown").join(persons if few else persons.select("id", "label", "sex").distinct(), "id")
    terms = [
        F.lit("self"),
        _by_sex("husband", "wife", "spouse"),
        _by_sex("father", "mother", "parent"),
        _by_sex("son", "daughter", "child"),
        _by_sex("brother", "sister", "sibling"),
        _by_sex("paternal grandfather", "paternal grandmother", "paternal grandparent"),
        _by_sex("maternal grandfather", "maternal grandmother", "maternal grandparent"),
        _by_sex("grandson", "granddaughter", "grandchild"),
    ]
    kin = reduce(lambda c, i: c.when(F.col("o") == i, terms[i]), range(1, 8), F.when(F.col("o") == 0, terms[0])).otherwise("")
    return node.select("ego", "id", F.coalesce("label", "id").alias("label"), "sex", kin.alias("kin"))


def citizen_tree_nodes(egos: DataFrame, persons: DataFrame, child_of: DataFrame, spouse_of: DataFrame, depth: int = 3) -> DataFrame:
    """As the five-tier tree with depth - 1 generations each way and coarse kin: self, spouse, parent, child, relative."""
    hops = check_depth(depth) - 1
    e = settle(egos.join(persons.select("id"), "id", "left_semi").distinct(), "egos")
    up = settle(child_of.select(F.col("child").alias("id"), F.col("parent").alias("to")).distinct(), "edges")
    down = up.select(F.col("to").alias("id"), F.col("id").alias("to"))
    then = lambda df, more: df.select("ego", F.col("to").alias("id")).join(more, "id").select("ego", "to")
    start = e.select(F.col("id").alias("ego"), F.col("id").alias("to"))
    # every way to be in a tree is a row with the order of its term, the first of which holds
    ways = [start.withColumn("o", F.lit(0)), then(start, symmetric(spouse_of).select(F.col("a").alias("id"), F.col("b").alias("to"))).withColumn("o", F.lit(1))]
    for step, near in ((down, 2), (up, 3)):
        front = start
        for d in range(hops):
            front = then(front, step)
            ways.append(front.withColumn("o", F.lit(near if d == 0 else 4)))
    best = reduce(DataFrame.unionByName, ways).groupBy("ego", F.col("to").alias("id")).agg(F.min("o").alias("o"))
    kin = F.element_at(F.array(*map(F.lit, ("self", "spouse", "child", "parent", "relative"))), F.col("o") + 1)
    return best.join(persons, "id").select("ego", "id", F.coalesce("label", "id").alias("label"), "sex", F.lit("citizen").alias("person_type"), kin.alias("kin"))


def resident_tree(egos: DataFrame, persons: DataFrame, sponsored_by: DataFrame, depth: int = 2, links: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges up to ``depth`` sponsorship steps both ways; ``sponsored_by(child, parent)``.

    Numbers are walked in place of ids, up only: a way down is one up from its
    other end.  With the ``links`` that ``sponsored_by`` stands for, edges have
    their ``relation`` as by ``with_relations``, found once for each link.
    """
    check_depth(depth, 3)
    if links is None:
        one = sponsored_by.select("child", "parent").distinct()
    else:
        one = links.groupBy(F.col("sponsored_entity_person_id").alias("child"), F.col("sponsor_entity_person_id").alias("parent")).agg(F.min("relation_to_sponsor").alias("relation"))
    one = settle(one, "links")
    ids = persons.select("id").unionByName(one.select(F.explode(F.array("child", "parent")).alias("id"))).distinct()
    known = settle(ids.select("id", F.monotonically_increasing_id().alias("code")), "codes")
    code = lambda df, c: df.join(known.select(F.col("id").alias(c), F.col("code").alias(f"_{c}")), c).drop(c).withColumnRenamed(f"_{c}", c)
    name = lambda df, c: df.join(known.select(F.col("code").alias(c), F.col("id").alias(f"_{c}")), c).drop(c).withColumnRenamed(f"_{c}", c)
    edges = settle(code(code(one, "child"), "parent"), "walk")
    e = settle(code(egos.select("id").distinct(), "id").select(F.col("id").alias("ego")), "egos")
    who = settle(code(persons.withColumn("_name", F.col("id")), "id"), "persons")
    e = e.join(who.select(F.col("id").alias("ego")), "ego", "left_semi")
    step = edges.select(F.col("child").alias("at"), F.col("parent").alias("to"))
    ways = [step.select(F.col("at").alias("from"), "to")]
    for _ in range(depth - 1):
        ways.append(ways[-1].withColumnRenamed("to", "at").join(step, "at").select("from", "to"))
    ways = reduce(DataFrame.unionByName, ways)
    both = ways.select(F.col("from").alias("ego"), F.col("to").alias("id")).unionByName(ways.select(F.col("to").alias("ego"), F.col("from").alias("id")))
    rows = both.join(e, "ego", "left_semi").unionByName(e.select("ego", F.col("ego").alias("id"))).distinct()
    rows = settle(rows.join(who.select("id").distinct(), "id", "left_semi").select("ego", "id"), "tree")
    nodes = name(rows.join(who, "id").select("ego", F.col("_name").alias("id"), F.coalesce("label", "_name").alias("label"), "sex", "person_type"), "ego").select("ego", "id", "label", "sex", "person_type")
    src, dst = rows.select("ego", F.col("id").alias("source")), rows.select("ego", F.col("id").alias("target"))
    found = src.join(edges.withColumnsRenamed({"child": "source", "parent": "target"}), "source").join(dst, ["ego", "target"], "left_semi")
    found = name(name(name(found, "target"), "source"), "ego").withColumn("type", F.lit("SPONSORED_BY"))
    return nodes, found.select("ego", "source", "target", "type", *(["relation"] if links is not None else []))


def with_relations(edges: DataFrame, links: DataFrame) -> DataFrame:
    """Edges of resident trees with ``relation``, that of the link they stand for; of several the smallest."""
    known = links.groupBy(F.col("sponsored_entity_person_id").alias("source"), F.col("sponsor_entity_person_id").alias("target")).agg(F.min("relation_to_sponsor").alias("relation"))
    return edges.join(known, ["source", "target"], "left").select("ego", "source", "target", "type", "relation")


def unified_tree(egos: DataFrame, citizens: DataFrame, residents: DataFrame) -> DataFrame:
    """Nodes of the citizens' tree of an ego, or of the residents' where the first has none."""
    c = citizens.select("ego", "id", "label", "sex", "person_type")
    r = residents.select("ego", "id", "label", "sex", "person_type").join(c.select("ego").distinct(), "ego", "left_anti")
    return c.unionByName(r).join(egos.select(F.col("id").alias("ego")).distinct(), "ego", "left_semi")


def tree_of_either(egos: DataFrame, citizens: DataFrame, child_of: DataFrame, spouse_of: DataFrame, residents: DataFrame, persons: DataFrame, sponsored_by: DataFrame) -> DataFrame:
    """As ``unified_tree`` of the trees of all ``egos(id)`` and ``residents(id)``: a citizen's tree has at least the citizen, so residents' trees are made of the others alone."""
    c = citizen_tree_nodes(egos.unionByName(residents), citizens, child_of, spouse_of).drop("kin")
    return c.unionByName(resident_tree(residents.join(citizens.select("id"), "id", "left_anti"), persons, sponsored_by)[0])


def sponsored_family(links: DataFrame, persons: DataFrame, sponsors: DataFrame) -> DataFrame:
    """``sponsors(id)`` -> one row each with the number and the sorted ids of those sponsored directly."""
    rows = links.select(F.col("parent").alias("id"), "child").distinct().join(persons.select(F.col("id").alias("child")), "child", "left_semi")
    return sponsors.distinct().join(rows, "id").groupBy(F.col("id").alias("sponsor")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("child")), ",").alias("sponsored"))


def relationships(edges: DataFrame) -> DataFrame:
    """``edges(ego, source, target, type)`` -> parents, children and spouses of each ego: ``(ego, relation, id)``."""
    t = F.upper("type")
    parents = edges.where((t == "CHILD_OF") & (F.col("source") == F.col("ego"))).select("ego", F.lit("parent").alias("relation"), F.col("target").alias("id"))
    children = edges.where((t == "CHILD_OF") & (F.col("target") == F.col("ego"))).select("ego", F.lit("child").alias("relation"), F.col("source").alias("id"))
    s = edges.where((t == "SPOUSE_OF") & ((F.col("source") == F.col("ego")) | (F.col("target") == F.col("ego"))))
    spouses = s.select("ego", F.lit("spouse").alias("relation"), F.when(F.col("source") == F.col("ego"), F.col("target")).otherwise(F.col("source")).alias("id"))
    return parents.unionByName(children).unionByName(spouses).distinct()


def fixed_ego(persons: DataFrame, child_of: DataFrame, spouse_of: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Egos with fixed roles: explicit close kin, and one cluster node each for grandparents, grandchildren and in-laws.

    Nodes (ego, id, kin), edges (ego, source, target, type); child edges run from child to parent.
    """
    e = persons.select(F.col("id").alias("ego"))
    s = symmetric(spouse_of)
    role = lambda df, a, b, o: df.select(F.col(a).alias("ego"), F.col(b).alias("id"), F.lit(o).alias("o"))
    rows = reduce(DataFrame.unionByName, [e.select("ego", F.col("ego").alias("id"), F.lit(0).alias("o")), role(s, "a", "b", 1), role(child_of, "child", "parent", 2), role(child_of, "parent", "child", 3), role(siblings(child_of), "id", "sibling", 4)])
    near = rows.join(e, "ego", "left_semi").groupBy("ego", "id").agg(F.min("o").alias("o"))
    sex = persons.select("id", "sex")
    names = [F.lit("self"), _by_sex("husband", "wife", "spouse"), _by_sex("father", "mother", "parent"), _by_sex("son", "daughter", "child"), _by_sex("brother", "sister", "sibling")]
    kin = reduce(lambda c, i: c.when(F.col("o") == i, names[i]), range(1, 5), F.when(F.col("o") == 0, names[0]))
    explicit = settle(near.join(sex, "id", "left").select("ego", "id", "o", kin.alias("kin")), "fixed")
    flag = lambda df, name: df.join(e, df["id"] == e["ego"], "left_semi").select(F.col("id").alias("ego"), F.lit(f"__cluster_{name}__").alias("id"), F.lit(name).alias("kin")).distinct()
    gp, gc, il = flag(grandparents(child_of), "grandparents"), flag(grandchildren(child_of), "grandchildren"), flag(inlaws(child_of, spouse_of), "inlaws")
    nodes = reduce(DataFrame.unionByName, [explicit.select("ego", "id", "kin"), gp, gc, il])

    def fan(cluster: DataFrame, o: int, kind: str, to_ego: bool) -> DataFrame:
        ends = cluster.select("ego", F.col("id").alias("source")).join(explicit.where(F.col("o") == o).select("ego", F.col("id").alias("target")), "ego", "left" if to_ego else "inner")
        return ends.select("ego", "source", F.coalesce("target", "ego").alias("target"), F.lit(kind).alias("type"))

    edges = reduce(DataFrame.unionByName, [induced_edges(explicit, child_of, spouse_of), fan(gp, 2, "ancestor", True), fan(gc, 3, "descendant", True), fan(il, 1, "in-law", False)])
    return nodes, edges
