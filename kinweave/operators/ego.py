"""Ego networks of all persons at once, by level-synchronous joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.kin import kin, kin_cluster
from ..functions.text import relation_label
from .tables import NAMES, SMALL, bucketed, hold, numbered, settle, small


def kin_steps(parent_links: DataFrame, spouse_links: DataFrame) -> DataFrame:
    """(from, to, kind): U to a parent, D to a child, S to a spouse, both ways."""
    c, p = F.col("child_entity_person_id"), F.col("parent_entity_person_id")
    h, w = F.col("husband_entity_person_id"), F.col("wife_entity_person_id")
    row = lambda df, a, b, kind: df.where(a.isNotNull() & b.isNotNull()).select(a.alias("from"), b.alias("to"), F.lit(kind).alias("kind"))
    return row(parent_links, c, p, "U").unionByName(row(parent_links, p, c, "D")).unionByName(row(spouse_links, h, w, "S")).unionByName(row(spouse_links, w, h, "S")).distinct()


def spouse_hubs(steps: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Distances over spouse steps without a row for each pair of persons: ``moves(from, to array<struct<hub, at, d>>)``, ``back(at, to, d)`` and the longest d.

    A couple of which neither has another spouse is one move.  Of each larger
    component one person is the hub, the one with most spouses: everybody gets
    its distance to the hub, the hub is taken out, and what is left is treated
    alike.  A shortest way between two persons leads through the hub of some
    round, so its length is the least sum of two distances to a common hub.  A
    star of any size has one hub; a person has about log2 of its component's size.
    """
    edges = settle(steps.where("kind = 'S'").where(F.col("from") != F.col("to")).select("from", "to").distinct(), "spouses")
    degree = edges.groupBy("from").agg(F.count("*").alias("k"))
    ends = edges.join(degree, "from").join(degree.select(F.col("from").alias("to"), F.col("k").alias("l")), "to").select("from", "to", "k", "l")
    ends = settle(ends, "ends")
    couple = ends.where("k = 1 and l = 1").select("from", F.lit(False).alias("hub"), F.col("to").alias("at"), F.lit(1).alias("d"))
    rest = settle(ends.where("k > 1 or l > 1").select("from", "to"), "rest")
    labels = None
    while rest.limit(1).count():
        near = rest.groupBy("from").agg(F.count("*").alias("k")).select(F.col("from").alias("id"), F.struct("k", F.col("from").alias("hub")).alias("p"), F.lit(0).alias("d"))
        before = None
        while True:  # everybody takes the foremost hub that a spouse knows, at the least distance
            ahead = rest.join(near, rest["from"] == near["id"]).select(F.col("to").alias("id"), "p", (F.col("d") + 1).alias("d"))
            near = near.unionByName(ahead).groupBy("id").agg(F.max(F.struct("p", (-F.col("d")).alias("m"))).alias("b")).select("id", "b.p", (-F.col("b.m")).alias("d"))
            near = settle(near, "hubs")
            now = near.agg(F.sum(F.xxhash64("id", "p", "d").cast("decimal(38,0)"))).first()[0]
            if now == before:
                break
            before = now
        found = near.select("id", F.col("p.hub").alias("at"), "d")
        labels = found if labels is None else labels.unionByName(found)
        taken = found.where("d = 0").select(F.col("id").alias("from"))
        rest = settle(rest.join(taken, "from", "left_anti").join(taken.withColumnRenamed("from", "to"), "to", "left_anti").select("from", "to"), "rest")
    if labels is None:
        labels = couple.select(F.col("from").alias("id"), "at", "d").limit(0)
    moves = couple.unionByName(labels.select(F.col("id").alias("from"), F.lit(True).alias("hub"), "at", "d"))
    moves = settle(moves.groupBy("from").agg(F.collect_list(F.struct("hub", "at", "d")).alias("to")), "moves")
    back = settle(labels.select("at", F.col("id").alias("to"), "d"), "back")
    return moves, back, back.agg(F.coalesce(F.max("d"), F.lit(0))).first()[0]


def near_steps(egos: DataFrame, steps: DataFrame, depth: int) -> DataFrame:
    """The steps that networks of these egos can take: only what they reach is walked, not the whole population.

    Whoever all egos together reach is collected generation by generation, with
    whole marriage chains; there is no row for each ego, so this costs less than
    the networks themselves.
    """
    vertical, married = steps.where("kind <> 'S'"), steps.where("kind = 'S'")
    hint = lambda df, n: F.broadcast(df) if n <= SMALL else df
    seen = front = settle(egos.select("id").distinct(), "near")
    total = count_ = front.count()

    def walk(over: DataFrame, start: DataFrame, n: int) -> tuple[DataFrame, int]:
        """Who one step from ``start`` leads to and nobody has reached yet."""
        ahead = over.join(hint(start.withColumnRenamed("id", "from"), n), "from", "left_semi").select(F.col("to").alias("id")).join(hint(seen, total), "id", "left_anti").distinct()
        new = settle(ahead.coalesce(1) if n <= SMALL // 100 else ahead, "near")
        return new, new.count()

    for g in range(depth + 1):
        if g:
            front, count_ = walk(vertical, front, count_)
            seen, total = seen.unionByName(front), total + count_
        wave, n = front, count_
        while n:
            wave, n = walk(married, wave, n)
            if n:
                seen, total, front, count_ = seen.unionByName(wave), total + n, front.unionByName(wave), count_ + n
    near = steps.join(hint(seen.withColumnRenamed("id", "from"), total), "from", "left_semi").select(*steps.columns)
    return settle(near.coalesce(1) if total <= SMALL // 100 else near, "steps")


class _Short:
    """A label (steps, signature) as one number: a leading 1, then two bits a step, so that numbers are ordered as labels are."""

    MOST = 31
    CODES = {"D": 0, "S": 1, "U": 2}

    @staticmethod
    def start() -> Column:
        return F.lit(1).cast("long")

    @staticmethod
    def step(label: Column, kind: Column) -> Column:
        return label * 4 + F.when(kind == "U", 2).otherwise(0)

    @staticmethod
    def spouses(label: str, k: str) -> Column:
        return F.expr(f"shiftleft({label}, 2 * ({k})) + (shiftleft(1L, 2 * ({k})) - 1) div 3")

    @staticmethod
    def append(label: str, way: str) -> Column:
        """A label and then a way of its own: ``way.s`` as a label, of ``way.n`` steps."""
        return F.expr(f"shiftleft({label}, 2 * {way}.n) + {way}.s - shiftleft(1L, 2 * {way}.n)")

    @staticmethod
    def parts(label: str) -> tuple[Column, Column]:
        path = F.translate(F.substring(F.conv(F.col(label).cast("string"), 10, 4), 2, _Short.MOST), "012", "DSU")
        return F.length(path), path


class _Long:
    """A label as (steps, signature), for marriage chains too long for a number."""

    @staticmethod
    def start() -> Column:
        return F.struct(F.lit(0).alias("n"), F.lit("").alias("path"))

    @staticmethod
    def step(label: Column, kind: Column) -> Column:
        return F.struct((label["n"] + 1).alias("n"), F.concat(label["path"], kind).alias("path"))

    @staticmethod
    def spouses(label: str, k: str) -> Column:
        return F.expr(f"named_struct('n', {label}.n + ({k}), 'path', concat({label}.path, repeat('S', {k})))")

    @staticmethod
    def parts(label: str) -> tuple[Column, Column]:
        return F.col(f"{label}.n"), F.col(f"{label}.path")


Hubs = tuple[DataFrame, DataFrame, int]


#: Bits of a label below its generation, and the most rows of composed ways for each step.
LABEL_BITS, WAYS = 59, 16
#: Persons, and composed ways of all of them, up to which ways are sent to all tasks (8 bytes a way, some 100 a person); and egos in one task.
SENT, SENT_WAYS, EGOS = 1_000_000, 32_000_000, 512


def _ways(egos: DataFrame, vertical: DataFrame, hubs: Hubs) -> tuple[DataFrame, DataFrame] | None:
    """Whole generations as single steps: who an ego is married to at any remove, and a parent or child with everybody married to it.

    ``(from, to, n, s)`` each, arrays of persons, of numbers of steps and of
    labels.  None where this would take more than WAYS rows for each step,
    as in a star of marriages: then the hubs are walked.
    """
    moves, back, longest = hubs
    sizes = back.groupBy("at").agg(F.count("*").alias("k"))
    each = moves.select("from", F.explode("to").alias("m")).select("from", "m.*")
    ends = each.join(sizes, "at", "left").groupBy("from").agg(F.sum(F.when(F.col("hub"), F.col("k")).otherwise(1)).alias("k"))
    ends = settle(ends, "sizes")
    steps, most = vertical.count(), ends.agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]
    taken = vertical.join(ends.withColumnRenamed("from", "to"), "to").agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]
    if most + taken > WAYS * max(steps + ends.count(), 1):
        return None
    met = each.where("hub").select("from", "at", "d").join(back.select("at", "to", F.col("d").alias("e")), "at").select("from", "to", (F.col("d") + F.col("e")).alias("k"))
    wed = each.where("not hub").select("from", F.col("at").alias("to"), F.col("d").alias("k")).unionByName(met).where(F.col("from") != F.col("to"))
    wed = settle(wed.groupBy("from", "to").agg(F.min("k").alias("k")), "wed")
    # numbers are kept as short as the longest way allows, as they are sent to tasks
    short = F.col("s").cast("smallint" if 2 * (1 + 2 * longest) < 15 else "long").alias("s")
    lists = lambda c: F.transform("w", lambda w: w[c]).alias(c)
    arrays = lambda df: settle(df.groupBy("from").agg(F.collect_list(F.struct("to", F.col("n").cast("smallint").alias("n"), short)).alias("w")).select("from", *map(lists, ("to", "n", "s"))), "ways")
    start = egos.select(F.col("id").alias("from")).distinct()
    own = start.select("from", F.col("from").alias("to"), F.lit(0).alias("n"), _Short.start().alias("s"))
    own = own.unionByName(start.join(wed, "from").select("from", "to", F.col("k").alias("n"), _Short.start().alias("l"), "k").select("from", "to", "n", _Short.spouses("l", "k").alias("s")))
    one = vertical.select("from", F.col("to").alias("via"), _Short.step(_Short.start(), F.col("kind")).alias("l"))
    more = one.join(wed.select(F.col("from").alias("via"), "to", "k"), "via").select("from", "to", (F.col("k") + 1).alias("n"), _Short.spouses("l", "k").alias("s"))
    gen = one.select("from", F.col("via").alias("to"), F.lit(1).alias("n"), F.col("l").alias("s")).unionByName(more)
    gen = gen.groupBy("from", "to").agg(F.min("s").alias("s"), F.min("n").alias("n"))  # a label of fewer steps is the smaller number
    return arrays(own), arrays(gen)


def _by_ways(own: DataFrame, ways: DataFrame, depth: int, parts: int, once: bool) -> DataFrame:
    """``_reached`` over composed ways: a generation is one join by person and one minimum by ego, over numbers with the generation in front of the label.

    Ways that can be sent to all tasks are: then only egos are dealt out, and
    nothing of the walk is shuffled or kept.
    """
    key = lambda g, label: F.shiftleft(F.lit(g).cast("long"), LABEL_BITS) + label
    label = F.col("key").bitwiseAND((1 << LABEL_BITS) - 1)
    size = ways.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("to")), F.lit(0)).alias("w")).first()
    sent = size.n <= SENT and size.w <= SENT_WAYS
    start = own.repartition(parts, "from") if sent else own
    reached = start.select(F.col("from").alias("ego"), F.posexplode("to").alias("i", "id"), "s").select("ego", "id", key(0, F.col("s")[F.col("i")].cast("long")).alias("key"))
    for g in range(1, depth + 1):
        last = F.shiftright("key", LABEL_BITS) == g - 1
        if sent:  # each row stays, and those of the last generation lead on
            ahead = reached.withColumn("at", F.when(last, F.col("id"))).join(F.broadcast(ways), F.col("at") == F.col("from"), "left")
            nobody = F.array().cast(ways.schema["to"].dataType)
            ahead = ahead.select("ego", "key", "n", "s", F.posexplode(F.concat(F.array("id"), F.coalesce("to", nobody))).alias("i", "id"))
            ahead = ahead.withColumn("l", label).withColumn("w", F.struct(F.get("n", F.col("i") - 1).cast("int").alias("n"), F.get("s", F.col("i") - 1).cast("long").alias("s")))
            reached = ahead.select("ego", "id", F.when(F.col("i") == 0, F.col("key")).otherwise(key(g, _Short.append("l", "w"))).alias("key")).groupBy("ego", "id").agg(F.min("key").alias("key"))
            continue
        front = reached.where(last).select("ego", F.col("id").alias("from"), label.alias("l"))
        ahead = front.join(ways, "from").select("ego", "l", "n", "s", F.posexplode("to").alias("i", "id"))
        ahead = ahead.withColumn("w", F.struct(F.col("n")[F.col("i")].cast("int").alias("n"), F.col("s")[F.col("i")].cast("long").alias("s"))).select("ego", "id", key(g, _Short.append("l", "w")).alias("key"))
        reached = reached.unionByName(ahead).repartition(parts, "ego").groupBy("ego", "id").agg(F.min("key").alias("key"))
        if g < depth or not once:
            reached = settle(reached, "level")
    if sent and not once:
        reached = bucketed(reached, "reached", "ego", parts, "id")
    return reached.select("ego", "id", F.shiftright("key", LABEL_BITS).cast("int").alias("g"), label.alias("label"))


def citizen_reach(egos: DataFrame, steps: DataFrame, depth: int = 3, hubs: Hubs | None = None) -> DataFrame:
    """``egos(id)`` -> ``(ego, id, g, n, path)``: every person within ``depth`` generations, spouses at no cost.

    A person keeps its smallest label (g, n, path): generations, steps, and the
    signature.  A generation is a join with parents and children, then one from
    persons to the hubs of their marriages and one from hubs to persons, and one
    anti join with who was reached before: a chain through a person of an earlier
    generation leads only to persons of that generation.

    While the steps are small enough to be sent to all tasks, rows stay
    partitioned by ego from the first level to the last and nothing is shuffled.
    ``hubs``: those of the steps, where these are the few near some egos; levels are then kept in the plan.
    """
    reached, label = _reached(egos, steps, depth, hubs)
    n, path = label.parts("label")
    return reached.select("ego", "id", "g", n.cast("int").alias("n"), path.alias("path"))


def _reached(egos: DataFrame, steps: DataFrame, depth: int, hubs: Hubs | None, once: bool = False, parts: int | None = None) -> tuple[DataFrame, type[_Short] | type[_Long]]:
    """As ``citizen_reach``, with labels as they are kept, and what reads them.  ``once``: the rows are read once, so the last level need not be kept.

    ``parts``: of how many parts the rows are, dealt by ego; else by the session and the number of egos.
    """
    if not 1 <= depth <= 5:
        raise ValueError("depth must be from 1 to 5")
    spark = steps.sparkSession
    few = hubs is not None
    moves, back, longest = hubs or spouse_hubs(steps)
    label = _Short if depth + 2 * longest * (depth + 1) <= _Short.MOST else _Long
    vertical = steps.where("kind <> 'S'")
    parts = parts or (int(spark.conf.get("spark.sql.shuffle.partitions")) if few else max(int(spark.conf.get("spark.sql.shuffle.partitions")), egos.count() // EGOS))
    tables, sizes = (vertical, moves, back), []
    if not few:
        if 2 * (depth + 2 * longest * (depth + 1)) < LABEL_BITS - 1:
            composed = _ways(egos, vertical, (moves, back, longest))
            if composed is not None:
                return _by_ways(*composed, depth, parts, once), _Short
        sizes = [t.count() for t in tables]
        tables = tuple(F.broadcast(t) if n <= SMALL else t for t, n in zip(tables, sizes, strict=True))
    vertical, moves, back = tables
    together = not few and max(sizes) <= SMALL
    keep = (lambda df: bucketed(df, "level", "ego", parts)) if together else (lambda df: hold(df, "level", few))
    reached = None
    level = egos.distinct().select(F.col("id").alias("ego"), "id", label.start().alias("label"))
    level = level.repartition(parts, "ego") if together else level
    least = F.min("label").alias("label")
    for g in range(depth + 1):
        if g:
            level = level.join(vertical, level["id"] == vertical["from"]).select("ego", F.col("to").alias("id"), label.step(F.col("label"), F.col("kind")).alias("label"))
        me = F.struct(F.lit(False).alias("hub"), F.col("id").alias("at"), F.lit(0).alias("d"))
        ahead = level.join(moves.withColumnRenamed("to", "more"), level["id"] == moves["from"], "left").select("ego", "label", F.explode(F.when(F.col("more").isNull(), F.array(me)).otherwise(F.concat(F.array(me), "more"))).alias("m"))
        ahead = ahead.select("ego", "m.hub", "m.at", label.spouses("label", "m.d").alias("label")).groupBy("ego", "hub", "at").agg(least)
        b = back.select(F.lit(True).alias("hub"), "at", "to", "d")
        level = ahead.join(b, ["hub", "at"], "left").select("ego", F.coalesce("to", "at").alias("id"), label.spouses("label", "coalesce(d, 0)").alias("label")).groupBy("ego", "id").agg(least)
        if reached is not None:
            level = level.join(reached.select("ego", "id"), ["ego", "id"], "left_anti")
        level = keep(level)
        done = level.withColumn("g", F.lit(g))
        reached = done if reached is None else reached.unionByName(done)
    return reached.select("ego", "id", "g", "label"), label


def path_counts(egos: DataFrame, steps: DataFrame, persons: DataFrame, depth: int = 3) -> DataFrame:
    """``(path, sex, n)``: the signatures by which ``egos(id)`` reach others, with the sex of whom they lead to in ``persons(id, sex)``; the empty one leads to an ego itself.

    Numbers are walked in place of ids; a sex is the rest of a person's number, so it is known without a join.
    """
    sexes = settle(persons.select("sex").distinct().coalesce(1).select("sex", F.monotonically_increasing_id().alias("rest")), "sexes")
    kinds = sexes.count() + 1
    sex = persons.alias("p").join(F.broadcast(sexes.alias("s")), F.expr("p.sex <=> s.sex")).select("p.id", "s.rest")
    ids = egos.select("id").unionByName(steps.select(F.explode(F.array("from", "to")).alias("id"))).distinct().select("id", F.monotonically_increasing_id().alias("code"))
    known = settle(ids.join(sex, "id", "left").select("id", (F.col("code") * kinds + F.coalesce("rest", F.lit(kinds - 1))).alias("code")), "codes")
    code = lambda df, c: df.join(known.select(F.col("id").alias(c), F.col("code").alias(f"_{c}")), c).drop(c).withColumnRenamed(f"_{c}", c)
    reach, label = _reached(code(egos.select("id"), "id"), settle(code(code(steps, "from"), "to").select("from", "to", "kind"), "walk"), depth, None, once=True)
    rows = reach.groupBy("label", F.pmod("id", F.lit(kinds)).alias("rest")).agg(F.count("*").alias("n"))
    rows = rows.join(F.broadcast(sexes), "rest", "left").select(label.parts("label")[1].alias("path"), "sex", "n")
    return rows.groupBy("path", "sex").agg(F.sum("n").alias("n"))


def citizen_ego(persons: DataFrame, parent_links: DataFrame, spouse_links: DataFrame, ids: DataFrame | None = None, lang: str = "en", depth: int = 3) -> tuple[DataFrame, DataFrame]:
    """Nodes (ego, id, label, sex, kin, cluster) and edges (ego, source, target, type) of the egos in ``ids``, or of all persons.

    ``persons(id, label, sex)``.  Egos that are no person have no row.
    """
    egos = persons.select("id") if ids is None else ids.join(persons.select("id"), "id", "left_semi")
    steps = settle(kin_steps(parent_links, spouse_links), "steps")  # both loops and the edges read it
    if ids is not None:
        steps = near_steps(egos, steps, depth)
    return networks(egos, steps, persons, lang, depth)


def _by_waves(egos: DataFrame, walk: DataFrame, depth: int) -> DataFrame:
    """As ``_reached`` with long labels, for few egos whose networks may be most of the population, over steps that go both ways.

    Each wave joins who was reached last with one step, and rows are dealt by ego
    and person, so a network is in many tasks; nobody else's marriages are looked at.
    """
    if not 1 <= depth <= 5:
        raise ValueError("depth must be from 1 to 5")
    parts = int(walk.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = bucketed(walk.repartition(parts, "from"), "walk", "from", parts)
    vertical, married = steps.where("kind <> 'S'"), steps.where("kind = 'S'")
    taken = lambda df, over: df.withColumnRenamed("id", "from").join(over, "from").select("ego", F.col("to").alias("id"), F.concat("path", "kind").alias("path"))
    long_ = F.length("path")
    reached = None
    ahead = egos.distinct().select(F.col("id").alias("ego"), "id", F.lit("").alias("path"))
    for g in range(depth + 1):
        if g:
            ahead = taken(small(front_of), vertical).groupBy("ego", "id").agg(F.min(F.struct(long_.alias("n"), "path")).alias("l")).select("ego", "id", "l.path")
            ahead = ahead.join(reached.select("ego", "id"), ["ego", "id"], "left_anti")
        ahead = settle(ahead, "ahead")
        lengths = sorted(r.n for r in ahead.select(long_.alias("n")).distinct().collect())
        front, n, waves = None, 0, []
        while lengths or front is not None:
            n = n + 1 if front is not None else lengths[0]
            new = [] if front is None else [taken(front, married)]
            if lengths and lengths[0] == n:
                new.append(ahead.where(long_ == lengths.pop(0)))
            best = reduce(DataFrame.unionByName, new).groupBy("ego", "id").agg(F.min("path").alias("path"))
            known = ([] if reached is None else [reached.select("ego", "id")]) + [w.select("ego", "id") for w in waves]
            if known:
                best = best.join(reduce(DataFrame.unionByName, known), ["ego", "id"], "left_anti")
            wave = settle(best, "wave")
            count = wave.count()
            front = None
            if count:
                waves.append(wave)
                front = F.broadcast(wave) if count <= SMALL else wave
        if not waves:
            break
        front_of = settle(reduce(DataFrame.unionByName, waves), "level")
        done = front_of.withColumn("g", F.lit(g))
        reached = done if reached is None else reached.unionByName(done)
    return reached.select("ego", "id", "g", F.struct(long_.alias("n"), "path").alias("label"))


def networks(egos: DataFrame, steps: DataFrame, persons: DataFrame, lang: str = "en", depth: int = 3, hubs: Hubs | None = None, few: bool = False) -> tuple[DataFrame, DataFrame]:
    """As ``citizen_ego``, of ``egos(id)`` over ``steps(from, to, kind)``.

    Numbers stand for ids in the walk and are joined back to the result; with
    ``hubs`` (see ``citizen_reach``) the steps are few, and ids are walked as they are.
    ``few``: the egos are few, the steps everybody's (see ``_by_waves``).
    """
    if hubs is not None:
        reach, label = _reached(egos, steps, depth, hubs)
        reach = reach.withColumn("path", label.parts("label")[1]).drop("label")
        term = F.when(F.col("ego") == F.col("id"), kin(F.lit(""), F.lit(None).cast("string"), lang)).otherwise(kin("path", "sex", lang))
        nodes = reach.join(F.broadcast(persons), "id", "left").select("ego", "id", F.coalesce("label", "id").alias("label"), "sex", term.alias("kin"))
        return nodes.withColumn("cluster", kin_cluster("kin")), _walked(reach, F.broadcast(steps), depth)
    known, walk = _coded(egos, steps, persons, few)
    whose = known.join(F.broadcast(egos.select("id")), "id", "left_semi")
    known = small(known, NAMES)
    code = lambda df, c: df.join(known.select(F.col("id").alias(c), F.col("code").alias(f"_{c}")), c).drop(c).withColumnRenamed(f"_{c}", c)
    name = lambda df, c: df.join(known.select(F.col("code").alias(c), F.col("id").alias(f"_{c}")), c).drop(c).withColumnRenamed(f"_{c}", c)
    if few:
        reach, label = _by_waves(whose.select(F.col("code").alias("id")), walk, depth), _Long
        of_ego = lambda df: df.join(F.broadcast(whose.select(F.col("code").alias("ego"), F.col("id").alias("_ego"))), "ego").drop("ego").withColumnRenamed("_ego", "ego")
    else:
        reach, label = _reached(code(egos.select("id"), "id"), walk, depth, None)
        of_ego = lambda df: name(df, "ego")
    terms = _terms(reach, label, lang)
    nodes = reach.withColumnRenamed("label", "l").withColumnRenamed("id", "code").join(known.withColumn("s", _sex()), "code").join(terms, ["l", "s"])
    nodes = nodes.select("ego", "id", F.coalesce("label", "id").alias("label"), "sex", *_own(lang))
    nodes = of_ego(nodes).select("ego", "id", "label", "sex", "kin", "cluster")
    edges = _walked_once(reach, walk, depth)
    return nodes, name(name(of_ego(edges), "source"), "target").select("ego", "source", "target", "type")


def _coded(egos: DataFrame, steps: DataFrame, persons: DataFrame, few: bool = False) -> tuple[DataFrame, DataFrame]:
    """Numbers in the order of ids, ``(id, code, label, sex)``, and the steps over them."""
    ends = steps.select(F.col("from").alias("id")).distinct() if few else steps.select(F.explode(F.array("from", "to")).alias("id"))
    known = settle(numbered(egos.select("id").unionByName(ends), "id").join(persons, "id", "left"), "known")
    codes = small(known, NAMES)
    code = lambda df, c: df.join(codes.select(F.col("id").alias(c), F.col("code").alias(f"_{c}")), c).drop(c).withColumnRenamed(f"_{c}", c)
    return known, settle(code(code(steps, "from"), "to").select("from", "to", "kind"), "walk")


def _sex() -> Column:
    return F.when(F.col("sex").isin("M", "F"), F.col("sex")).otherwise("?")


def _terms(reach: DataFrame, label: type[_Short] | type[_Long], lang: str) -> DataFrame:
    """``(l, s, kin, cluster)``: a signature's term is made once for each sex, not for each person that it leads to."""
    signs = settle(reach.select(F.col("label").alias("l")).distinct(), "signs")
    terms = signs.select("l", F.explode(F.array(*map(F.lit, "MF?"))).alias("s"), label.parts("l")[1].alias("path"))
    terms = terms.select("l", "s", kin("path", "s", lang).alias("kin")).select("l", "s", "kin", kin_cluster("kin").alias("cluster"))
    return F.broadcast(terms) if signs.count() * 3 <= SMALL else terms


def _own(lang: str) -> list[Column]:
    """``kin`` and ``cluster`` of rows ``(ego, code, kin, cluster)``: an ego is itself, whatever its sex."""
    own, itself = F.col("ego") == F.col("code"), kin(F.lit(""), F.lit(None).cast("string"), lang)
    return [F.when(own, itself).otherwise(F.col("kin")).alias("kin"), F.when(own, kin_cluster(itself)).otherwise(F.col("cluster")).alias("cluster")]


def folded_citizen_ego(persons: DataFrame, parent_links: DataFrame, spouse_links: DataFrame, lang: str = "en", depth: int = 3, parts: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The networks of ``citizen_ego`` in numbers: a row ``(ego, ids, labels, links)`` for each, names ``(id, code, label, sex)`` and terms ``(l, s, kin, cluster)``.

    ``ids`` are codes, in the order of ids; ``links`` are edges ``(s, t, spouse)`` between
    places in ``ids``, in the order of their ends.  Rows are dealt by ego into ``parts``.
    """
    egos, steps = persons.select("id"), settle(kin_steps(parent_links, spouse_links), "steps")
    known, walk = _coded(egos, steps, persons)
    codes = small(known, NAMES)
    start = egos.join(codes.select("id", "code"), "id").select(F.col("code").alias("id"))
    reach, label = _reached(start, walk, depth, None, parts=parts)
    nets = reach.groupBy("ego").agg(F.sort_array(F.collect_list(F.struct("id", "label"))).alias("at")).select("ego", F.col("at.id").alias("ids"), F.col("at.label").alias("labels"))
    ends = _walked_once(reach, walk, depth, places=True).groupBy("ego").agg(F.sort_array(F.collect_list(F.struct("s", "t", "spouse"))).alias("links"))
    none = F.array().cast("array<struct<s: int, t: int, spouse: boolean>>")
    return nets.join(ends, "ego", "left").select("ego", "ids", "labels", F.coalesce("links", none).alias("links")), known, _terms(reach, label, lang)


def named_networks(networks_: DataFrame, names: DataFrame, terms: DataFrame, lang: str = "en") -> DataFrame:
    """``(ego, nodes, edges)`` of ``folded_citizen_ego``'s rows, with the id of the ego: nodes (id, label, sex, kin, cluster) and edges (source, target, type), both sorted.

    Rows that are bucketed by ego stay where they are while names are broadcast.
    """
    i = F.col("i")
    rows = networks_.select("ego", F.posexplode("ids").alias("i", "code"), "labels", "links").select("ego", "i", "code", F.get("labels", i).alias("l"), F.when(i == 0, F.col("links")).alias("links"))
    rows = rows.join(small(names, NAMES).withColumn("s", _sex()), "code").join(small(terms), ["l", "s"])
    rows = rows.select("ego", "i", "code", "id", F.coalesce("label", "id").alias("label"), "sex", *_own(lang), "links")
    root = F.first(F.when(F.col("code") == F.col("ego"), F.col("id")), ignorenulls=True).alias("root")
    whole = rows.groupBy("ego").agg(F.sort_array(F.collect_list(F.struct("i", "id", "label", "sex", "kin", "cluster"))).alias("n"), F.first("links", ignorenulls=True).alias("links"), root)
    edge = lambda e: F.struct(F.col("n")[e["s"]]["id"].alias("source"), F.col("n")[e["t"]]["id"].alias("target"), F.when(e["spouse"], "SPOUSE_OF").otherwise("CHILD_OF").alias("type"))
    node = lambda x: F.struct(*(x[c].alias(c) for c in ("id", "label", "sex", "kin", "cluster")))
    return whole.select(F.col("root").alias("ego"), F.transform("n", node).alias("nodes"), F.transform("links", edge).alias("edges"))


def _walked(reach: DataFrame, steps: DataFrame, depth: int) -> DataFrame:
    """``reach(ego, id, g)`` -> ``(ego, source, target, type)``: every step from persons that are expanded, children to parents, spouses both ways."""
    walked = reach.select("ego", F.col("id").alias("from"), "g").join(steps, "from").where((F.col("kind") == "S") | (F.col("g") < depth))
    down, spouse = F.col("kind") == "D", F.col("kind") == "S"
    one = F.struct(F.when(down, F.col("to")).otherwise(F.col("from")).alias("source"), F.when(down, F.col("from")).otherwise(F.col("to")).alias("target"))
    both = F.when(spouse, F.array(one, F.struct(F.col("to").alias("source"), F.col("from").alias("target")))).otherwise(F.array(one))
    edges = walked.select("ego", F.explode(both).alias("e"), spouse.alias("spouse")).select("ego", "e.source", "e.target", "spouse").distinct()
    return edges.select("ego", "source", "target", F.when(F.col("spouse"), "SPOUSE_OF").otherwise("CHILD_OF").alias("type"))


#: Persons of a network up to which it is one row while its edges are found.
WIDE = 2_000


def _walked_once(reach: DataFrame, steps: DataFrame, depth: int, places: bool = False) -> DataFrame:
    """As ``_walked``, where the steps are distinct and go both ways: each edge is taken from one of its ends, so edges are not compared with one another.

    A person's spouses are in its network, so a step to each is all.  An edge to a
    parent is taken from the child, if that is expanded; else the child was reached
    in the last generation, from a parent of the one before.

    Where steps can be sent to all tasks and networks are not large, a network
    meets them as one row, which holds those of the generation before the last.
    ``places``: ``(ego, s, t, spouse)``, of ends their places from 0 among the ids of the network.
    """
    wide = settle(reach.groupBy("ego").agg(F.count("*").alias("n")).where(F.col("n") > WIDE).select("ego"), "wide")
    if steps.select("from").distinct().count() <= NAMES:
        several = wide.limit(1).count() > 0
        found = _met(reach.join(small(wide), "ego", "left_anti") if several else reach, steps, depth, places)
        if not several:
            return found
        return found.unionByName(_compared(reach.join(small(wide), "ego", "left_semi"), steps, depth, places))
    return _compared(reach, steps, depth, places)


def _met(reach: DataFrame, steps: DataFrame, depth: int, places: bool) -> DataFrame:
    """``_walked_once`` of networks that are one row each, over steps that are sent to all tasks."""
    of = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.col("to")))
    adjacent = steps.where("kind <> 'D'").groupBy("from").agg(of("U").alias("up"), of("S").alias("wed"))
    adjacent = settle(adjacent.select("from", F.size("up").alias("ups"), F.concat("up", "wed").alias("to")), "adjacent")
    every = F.sort_array(F.collect_list(F.struct("id", "g"))).alias("at")
    nets = reach.groupBy("ego").agg(every, F.collect_list(F.when(F.col("g") == depth - 1, F.col("id"))).alias("near"))
    each = nets.select("ego", "near", F.col("at.id").alias("ids"), F.posexplode("at").alias("s", "x")).select("ego", "near", "ids", "s", F.col("x.id").alias("from"), "x.g")
    found = each.join(F.broadcast(adjacent), "from").select("ego", "near", "ids", "s", "from", "g", "ups", F.posexplode("to").alias("i", "to"))
    up = F.col("i") < F.col("ups")
    found = found.where(~up | (F.col("g") < depth) | F.array_contains("near", F.col("to")))
    if places:
        return found.select("ego", "s", (F.array_position("ids", F.col("to")) - 1).cast("int").alias("t"), (~up).alias("spouse"))
    return found.select("ego", F.col("from").alias("source"), F.col("to").alias("target"), F.when(up, "CHILD_OF").otherwise("SPOUSE_OF").alias("type"))


def _compared(reach: DataFrame, steps: DataFrame, depth: int, places: bool) -> DataFrame:
    """``_walked_once`` by joins over all rows, however large a network is."""
    at = lambda df: df.select("ego", F.col("id").alias("from"))
    of = lambda kind: steps.where(F.col("kind") == kind).groupBy("from").agg(F.collect_list("to").alias("to"))
    meet = lambda df, kind: at(df).join(small(settle(of(kind), "adjacent")), "from").select("ego", "from", F.explode("to").alias("to"))
    edge = lambda df, kind, a="from", b="to": df.select("ego", F.col(a).alias("source"), F.col(b).alias("target"), F.lit(kind).alias("type"))
    last = reach.where(F.col("g") == depth).select("ego", F.col("id").alias("to"))
    below = meet(reach.where(F.col("g") == depth - 1), "D").join(last, ["ego", "to"], "left_semi")
    edges = edge(meet(reach, "S"), "SPOUSE_OF").unionByName(edge(meet(reach.where(F.col("g") < depth), "U"), "CHILD_OF")).unionByName(edge(below, "CHILD_OF", "to", "from"))
    if not places:
        return edges
    place = reach.select("ego", "id", (F.row_number().over(Window.partitionBy("ego").orderBy("id")) - 1).alias("i"))
    end = lambda df, c, i: df.join(place.select("ego", F.col("id").alias(c), F.col("i").alias(i)), ["ego", c])
    return end(end(edges, "source", "s"), "target", "t").select("ego", "s", "t", (F.col("type") == "SPOUSE_OF").alias("spouse"))


def with_details(nodes: DataFrame, entities: DataFrame) -> DataFrame:
    """``nodes`` of networks with ``label_ar`` and ``dob`` of ``entities(entity_person_id, full_name_ar, dob)``; a node that is no entity has none."""
    more = entities.select(F.col("entity_person_id").alias("id"), F.coalesce("full_name_ar", "full_name").alias("label_ar"), F.col("dob").cast("string").alias("dob"))
    return nodes.join(more, "id", "left").select(*nodes.columns, "label_ar", "dob")


#: Order of the ways to reach a person in one level of a sponsorship network.
UP, DOWN, PEER = 1, 2, 3


def _sponsor_moves(residents: DataFrame, links: DataFrame, groups: DataFrame, lang: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Steps up and down ``(from, to, way, role, relation)``, and ``(family_group_id, member, relation)``."""
    one = links.groupBy(F.col("sponsored_entity_person_id").alias("from")).agg(F.min(F.struct("sponsor_type", F.col("sponsor_entity_person_id").alias("to"), "relation_to_sponsor")).alias("s"))
    up = one.select("from", "s.to", F.lit(UP).alias("way"), F.when(F.col("s.sponsor_type") == "citizen", "citizen_sponsor").otherwise("resident_sponsor").alias("role"), F.col("s.relation_to_sponsor").alias("relation"))
    down = links.groupBy(F.col("sponsor_entity_person_id").alias("from"), F.col("sponsored_entity_person_id").alias("to")).agg(F.min("relationship_code").alias("code"))
    down = down.select("from", "to", F.lit(DOWN).alias("way"), F.lit("sponsored_resident").alias("role"), relation_label("code", lang).alias("relation"))
    member = groups.select("family_group_id", F.col("entity_person_id").alias("member")).distinct()
    code = residents.select(F.col("entity_person_id").alias("member"), relation_label("relationship_code", lang).alias("relation"))
    return up, down, member.join(code, "member", "left")


def resident_ego(residents: DataFrame, links: DataFrame, groups: DataFrame, names: DataFrame, ids: DataFrame | None = None, lang: str = "en", depth: int = 2) -> tuple[DataFrame, DataFrame]:
    """Sponsorship networks: nodes (ego, id, label, sex, role, relation, cluster) and edges (ego, source, target, type).

    Level by level, a person is reached once: first as sponsor, then as
    sponsored, then as member of the same family group; from the smallest id if
    several reach it.  Group members are not expanded.  A resident has one
    sponsor here: a citizen rather than a resident, then the smallest id.
    ``names(id, label, sex)`` may hold both populations.

    To depth 2 the networks come from references to lists: rows of networks are in no shuffle.
    """
    if not 1 <= depth <= 3:
        raise ValueError("depth must be from 1 to 3")
    if depth <= 2:
        reached = _unfold(*folded_networks(residents, links, groups, ids, lang, depth), names)
    else:
        reached = _by_levels(residents, links, groups, ids, lang, depth).join(names, "id", "left")
    return _sponsored_nodes(reached), _sponsored_edges(reached)


def _sponsored_nodes(reached: DataFrame) -> DataFrame:
    clusters = F.when(F.col("way") == 0, "ego").when(F.col("way") == UP, "sponsors").when(F.col("way") == DOWN, "sponsored").otherwise("family")
    return reached.select("ego", "id", F.coalesce("label", "id").alias("label"), "sex", "role", "relation", clusters.alias("cluster"))


def _sponsored_edges(reached: DataFrame) -> DataFrame:
    flip = F.col("way") == DOWN
    return reached.where("way > 0").select("ego", F.when(flip, F.col("id")).otherwise(F.col("from")).alias("source"), F.when(flip, F.col("from")).otherwise(F.col("id")).alias("target"), F.when(F.col("way") == PEER, "SAME_FAMILY_GROUP").otherwise("SPONSORED_BY").alias("type"))


def _by_levels(residents: DataFrame, links: DataFrame, groups: DataFrame, ids: DataFrame | None, lang: str, depth: int) -> DataFrame:
    """``(ego, id, from, way, role, relation)`` by a join and an anti join for each level."""
    up, down, member = _sponsor_moves(residents, links, groups, lang)
    moves = small(settle(up.unionByName(down), "moves"))
    member = small(settle(member, "members"))
    start = residents.select(F.col("entity_person_id").alias("id")).distinct()
    start = start if ids is None else start.join(ids, "id", "left_semi")
    reached = front = settle(start.select(F.col("id").alias("ego"), "id", F.lit(None).cast("string").alias("from"), F.lit(0).alias("way"), F.lit("self").alias("role"), F.lit(None).cast("string").alias("relation")), "start")
    for _ in range(depth):
        ahead = front.where(F.col("way") < PEER).select("ego", F.col("id").alias("from"))
        # a person meets its group, and the group its members: pairs of members are rows of networks only
        inside = ahead.join(member.select(F.col("member").alias("from"), "family_group_id"), "from").join(member, "family_group_id").where(F.col("from") != F.col("member"))
        inside = inside.select("ego", "from", F.col("member").alias("to"), F.lit(PEER).alias("way"), F.lit("family_member").alias("role"), "relation")
        seen = ahead.join(moves, "from").select("ego", "from", "to", "way", "role", "relation").unionByName(inside).where("to <> ego")
        best = seen.groupBy("ego", F.col("to").alias("id")).agg(F.min(F.struct("way", "from", "role", "relation")).alias("b"))
        new = best.select("ego", "id", "b.from", "b.way", "b.role", "b.relation").join(reached.select("ego", "id"), ["ego", "id"], "left_anti")
        front = settle(new, "front")
        reached = reached.unionByName(front)
    return reached


def folded_networks(residents: DataFrame, links: DataFrame, groups: DataFrame, ids: DataFrame | None = None, lang: str = "en", depth: int = 2) -> tuple[DataFrame, DataFrame]:
    """Sponsorship networks without a row for every member of every network: references and the lists that they name.

    ``refs(ego, level, from, way, at, n, role, relation)``: a sponsor is named
    itself (n = 1); those whom a person sponsors, and the members of a group, are
    one reference each, to a list of n.  ``lists(way, at, id, role, relation)``
    are kept once for all egos.  So a sponsor of m costs m references and a list
    of m, not m * m rows.  Lists are not followed further, so ``depth`` is 1 or
    2; ``unfolded`` gives the nodes of ``resident_ego``.
    """
    if not 1 <= depth <= 2:
        raise ValueError("depth must be 1 or 2")
    up, down, member = _sponsor_moves(residents, links, groups, lang)
    down, member = settle(down, "down"), settle(member, "members")
    peer = member.select(F.lit(PEER).alias("way"), F.col("family_group_id").alias("at"), F.col("member").alias("id"), F.lit("family_member").alias("role"), "relation")
    lists = down.select("way", F.col("from").alias("at"), F.col("to").alias("id"), "role", "relation").unionByName(peer)
    none, one = F.lit(None).cast("string"), F.lit(1).cast("long")
    # a person's references in one row, so that a level is one join
    ref = lambda way, at, n, role=none, relation=none: F.struct(F.lit(way).alias("way"), at.alias("at"), n.alias("n"), role.alias("role"), relation.alias("relation")).alias("r")
    sizes = member.groupBy("family_group_id").agg(F.count("*").alias("n"))
    cards = up.select("from", ref(UP, F.col("to"), one, F.col("role"), F.col("relation")))
    cards = cards.unionByName(down.groupBy("from").agg(F.count("*").alias("n")).select("from", ref(DOWN, F.col("from"), F.col("n"))))
    cards = cards.unionByName(member.join(sizes, "family_group_id").select(F.col("member").alias("from"), ref(PEER, F.col("family_group_id"), F.col("n"))))
    cards = settle(cards.groupBy("from").agg(F.collect_list("r").alias("refs")), "cards")

    def named(at: DataFrame, level: int) -> DataFrame:
        """The references of ``at(ego, from)``."""
        rows = at.join(cards, "from").select("ego", "from", F.explode("refs").alias("r")).select("ego", F.lit(level).alias("level"), "from", "r.*")
        return rows.where((F.col("way") != UP) | (F.col("at") != F.col("ego")))

    start = residents.select(F.col("entity_person_id").alias("ego")).distinct()
    start = start if ids is None else start.join(ids.select(F.col("id").alias("ego")), "ego", "left_semi")
    first = settle(named(start.select("ego", F.col("ego").alias("from")), 1), "refs")
    refs = start.select("ego", F.lit(0).alias("level"), none.alias("from"), F.lit(0).alias("way"), F.col("ego").alias("at"), one.alias("n"), F.lit("self").alias("role"), none.alias("relation")).unionByName(first)
    if depth > 1:  # sponsors, and those whom the ego sponsors itself; lists are not followed
        ahead = first.where(F.col("way") == UP).select("ego", F.col("at").alias("from"))
        below = first.where(F.col("way") == DOWN).select("ego").join(down.select(F.col("from").alias("ego"), F.col("to").alias("from")), "ego")
        # dealt by person: rows that repeat meet where they meet the person's references
        at = ahead.unionByName(below).where(F.col("from") != F.col("ego")).repartition("from").distinct()
        refs = refs.unionByName(named(at, 2))
    return refs, lists


#: Lists of one network up to which each carries the lists before it, and rows of a list that meet a network in one task.
LISTS, CHUNK = 64, 1024


def _unfold(refs: DataFrame, lists: DataFrame, names: DataFrame) -> DataFrame:
    """``(ego, id, way, from, role, relation, label, sex)`` of the networks: a person is reached at the least level, then by the first way, then from the smallest id.

    Rows of networks are not compared with one another: a list's row carries the
    lists that its person is in, a reference those that come before it in its
    network (as digests of 128 bits), and the row goes if it is in one of them.  A network of more than
    LISTS references is made by comparing rows.
    """
    key = lambda kind, at: F.unhex(F.md5(F.concat(kind.cast("string"), F.lit(":"), at)))
    kind = F.greatest("way", F.lit(UP))  # a person that is named is a list of one
    # of references to one list the first is enough: whoever it leads from was reached before
    best = refs.repartition("ego").groupBy("ego", kind.alias("kind"), "at").agg(F.min(F.struct("level", "way", "from", "role", "relation")).alias("b"))
    best = best.select("*", F.count("*").over(Window.partitionBy("ego")).alias("of"))
    order = F.struct("b.level", "b.way", "b.from", "kind", "at", "b.role", "b.relation")
    nets = settle(best.groupBy("ego").agg(F.sort_array(F.collect_list(F.when(F.col("of") <= LISTS, order))).alias("e"), F.max("of").alias("of")), "networks")
    entry = nets.select("ego", F.transform("e", lambda x: key(x["kind"], x["at"])).alias("keys"), F.posexplode("e").alias("i", "e"))
    entry = entry.select("ego", F.slice("keys", F.lit(1), F.col("i")).alias("before"), "e.*")
    # a person with its name and all lists that it is in
    on = lists.select("id", F.struct(F.col("way").alias("kind"), "at", F.col("role").alias("r_"), F.col("relation").alias("l_")).alias("l"), F.lit(None).cast("struct<label: string, sex: string>").alias("n"))
    about = on.unionByName(names.select("id", F.lit(None).cast(on.schema["l"].dataType).alias("l"), F.struct(F.col("label").cast("string").alias("label"), F.col("sex").cast("string").alias("sex")).alias("n")))
    about = settle(about.groupBy("id").agg(F.collect_list("l").alias("l"), F.max("n").alias("n")).select("id", "n.label", "n.sex", "l"), "about")
    inside = F.concat(F.array(key(F.lit(UP), F.col("id"))), F.transform("l", lambda x: key(x["kind"], x["at"]))).alias("inside")
    each = about.select("id", "label", "sex", inside, F.explode("l").alias("l")).select("id", "label", "sex", "inside", "l.*")
    cut = F.greatest(F.lit(1), F.ceil(F.col("n") / CHUNK)).cast("int")
    chunks = settle(lists.withColumnRenamed("way", "kind").groupBy("kind", "at").agg(F.count("*").alias("n")).select("kind", "at", cut.alias("cut")), "chunks")
    long_ = small(chunks.where("cut > 1"))
    salted = lambda df, salt: df.join(long_, ["kind", "at"], "left").withColumn("salt", salt).drop("cut")
    part = salted(each, F.pmod(F.hash("id"), F.coalesce("cut", F.lit(1))))
    every = salted(entry.where(F.col("kind") > UP).drop("role", "relation"), F.explode(F.sequence(F.lit(0), F.coalesce("cut", F.lit(1)) - 1)))
    out = ["ego", "id", "way", "from", "role", "relation", "label", "sex"]
    new = ~F.arrays_overlap("before", "inside")
    listed = every.join(part, ["kind", "at", "salt"]).where(new).select("ego", "id", "way", "from", F.col("r_").alias("role"), F.col("l_").alias("relation"), "label", "sex")
    direct = entry.where(F.col("kind") == UP).withColumnRenamed("at", "id").join(about.select("id", "label", "sex", inside), "id", "left")
    direct = direct.where(F.coalesce(new, ~F.array_contains("before", key(F.lit(UP), F.col("id"))))).select(*out)
    found = direct.unionByName(listed)
    large = nets.where(F.col("of") > LISTS).select("ego")
    if not large.limit(1).count():
        return found
    many = best.join(large, "ego", "left_semi").select("ego", "kind", "at", "b.*")
    named = many.where(F.col("kind") == UP).withColumnRenamed("at", "id").drop("kind")
    rows = many.where(F.col("kind") > UP).drop("role", "relation").join(each.drop("label", "sex", "inside").withColumnsRenamed({"r_": "role", "l_": "relation"}), ["kind", "at"]).where(F.col("id") != F.col("ego"))
    least = named.unionByName(rows.select(*named.columns)).groupBy("ego", "id").agg(F.min(F.struct("level", "way", "from", "role", "relation")).alias("b"))
    return found.unionByName(least.select("ego", "id", "b.way", "b.from", "b.role", "b.relation").join(about.drop("l"), "id", "left").select(*out))


def unfolded(refs: DataFrame, lists: DataFrame, names: DataFrame) -> DataFrame:
    """The nodes of ``resident_ego`` from references and lists."""
    return _sponsored_nodes(_unfold(refs, lists, names))
