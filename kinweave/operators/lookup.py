"""Networks, trees and common ancestors of few persons over an adjacency index: tables of steps and of persons, bucketed by id.

A frontier of few ids reads only its buckets, and what it finds stays in the
plan, so the cost follows the network and not the table.  A network of more than
NEAR persons is left to the joins over whole tables.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ego, graph
from .tables import settle

#: Persons that one lookup gathers at most.
NEAR = 5000

#: Ids up to which larger networks are walked wave by wave from these alone.
FEW = 64


def find(index: DataFrame, key: str, ids: list[str]) -> DataFrame:
    """The rows of an index with these keys; buckets without any are not read."""
    return index.where(F.col(key).isin(ids))


def _generations(ids: list[str], steps: dict[str, list[tuple[str, str]]], depth: int | None) -> dict[str, int]:
    """Generations from ``ids`` to everybody that known steps lead to, spouses at no cost; no step leads beyond ``depth``."""
    far: dict[str, int] = dict.fromkeys(ids, 0)
    queue = deque(ids)
    while queue:
        i = queue.popleft()
        for to, kind in steps.get(i, ()):
            g = far[i] + (kind != "S")
            if (depth is None or g <= depth) and g < far.get(to, g + 1):
                far[to] = g
                (queue.appendleft if kind == "S" else queue.append)(to)
    return far


def _hubs(steps: dict[str, list[tuple[str, str]]]) -> tuple[list[tuple[str, list[dict]]], list[tuple[str, str, int]], int]:
    """``ego.spouse_hubs`` of the persons that a lookup has gathered: moves, ways back, and the longest of these."""
    wed = {a: {b for b, kind in more if kind == "S" and b != a} for a, more in steps.items()}
    wed = {a: {b for b in more if b in wed} for a, more in wed.items()}
    moves: dict[str, list[dict]] = {a: [{"hub": False, "at": b, "d": 1} for b in more] for a, more in wed.items() if len(more) == 1 and all(len(wed[b]) == 1 for b in more)}
    rest = {a: set(more) for a, more in wed.items() if more and a not in moves}
    back = []
    while rest:
        seen: set[str] = set()
        taken = []
        for first in rest:
            if first in seen:
                continue
            piece, queue = {first}, [first]
            for a in queue:
                queue += sorted(rest[a] - piece)
                piece |= rest[a]
            seen |= piece
            hub = max(piece, key=lambda a: (len(rest[a]), a))
            taken.append(hub)
            far, queue = {hub: 0}, [hub]
            for a in queue:
                for b in rest[a] - far.keys():
                    far[b] = far[a] + 1
                    queue.append(b)
            for a, d in far.items():
                moves.setdefault(a, []).append({"hub": True, "at": hub, "d": d})
                back.append((hub, a, d))
        for hub in taken:
            for a in rest.pop(hub):
                rest[a].discard(hub)
        rest = {a: more for a, more in rest.items() if more}
    return list(moves.items()), back, max((d for _, _, d in back), default=0)


def near(steps: DataFrame, ids: list[str], depth: int | None, kinds: str = "UDS", most: int = NEAR) -> tuple[dict[str, list[tuple[str, str]]], list[str]] | None:
    """The steps from everybody within ``depth`` generations of ``ids``, and these persons; None if they are more than ``most``.

    Whoever is new is looked up at once, whatever step led there, so a network
    takes about as many lookups as its longest way has steps.
    """
    known: dict[str, list[tuple[str, str]]] = {}
    far = dict.fromkeys(ids, 0)
    while ask := [i for i in far if i not in known]:
        if len(far) > most:
            return None
        known |= {i: [] for i in ask}
        rows = find(steps, "from", ask).where(F.col("kind").isin(*kinds)).select("from", "to", "kind").limit(64 * most).toArrow()
        if rows.num_rows >= 64 * most:
            return None
        for a, b, kind in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            known[a].append((b, kind))
        far = _generations(ids, known, depth)
    return known, list(far)


def _steps(like: DataFrame, known: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """Gathered steps as a table in the plan."""
    flat = [(a, b, kind) for a, more in known.items() for b, kind in more]
    table = pa.table({n: pa.array([r[i] for r in flat], pa.string()) for i, n in enumerate(("from", "to", "kind"))})
    return like.sparkSession.createDataFrame(table, "`from` string, `to` string, kind string")


def _held(df: DataFrame) -> DataFrame:
    """A result of few rows, kept in the plan."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def _ids(df: DataFrame, ids: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(i,) for i in sorted(set(ids))], "id string")


def networks_of(steps: DataFrame, people: DataFrame, ids: list[str], lang: str = "en", depth: int = 3) -> tuple[DataFrame, DataFrame]:
    """As ``ego.citizen_ego``, for a list of ids over an index; ids that are no person have no row."""
    if not 1 <= depth <= 5:
        raise ValueError("depth must be from 1 to 5")
    persons = people.select("id", "label", "sex")
    reach = near(steps, ids, depth)
    if reach is None:
        egos = settle(_ids(people, ids).join(persons.select("id"), "id", "left_semi"), "egos")
        if len(ids) <= FEW:
            return ego.networks(egos, steps, persons, lang, depth, few=True)
        return ego.networks(egos, ego.near_steps(egos, steps, depth), persons, lang, depth)
    known, who = reach
    local = _held(find(persons, "id", who))
    moves, back, longest = _hubs(known)
    spark = people.sparkSession
    move = pa.list_(pa.struct([("hub", pa.bool_()), ("at", pa.string()), ("d", pa.int32())]))
    moves_ = pa.table({"from": pa.array([m[0] for m in moves], pa.string()), "to": pa.array([m[1] for m in moves], move)})
    back_ = pa.table({n: pa.array([r[i] for r in back], t) for i, (n, t) in enumerate((("at", pa.string()), ("to", pa.string()), ("d", pa.int32())))})
    hubs = (spark.createDataFrame(moves_, "`from` string, `to` array<struct<hub: boolean, at: string, d: int>>"), spark.createDataFrame(back_, "at string, `to` string, d int"), longest)
    return ego.networks(local.select("id").where(F.col("id").isin(ids)), _steps(steps, known), local, lang, depth, hubs)


def _edges(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    child_of = found.where("kind = 'U'").select(F.col("from").alias("child"), F.col("to").alias("parent"))
    return child_of, found.where("kind = 'S'").select(F.col("from").alias("a"), F.col("to").alias("b"))


def tree_of(steps: DataFrame, people: DataFrame, ids: list[str], depth: int = 3) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the five-tier trees of a list of ids over an index, as ``graph.five_tier_nodes`` and ``graph.induced_edges``."""
    graph.check_depth(depth)
    persons = people.select("id", "label", "sex")
    reach = near(steps, ids, 2)  # siblings and grandparents are two steps away
    if reach is None:
        child_of, spouse_of = _edges(steps)
        nodes = graph.five_tier_nodes(_ids(people, ids), persons, child_of, spouse_of, depth)
        return nodes, graph.induced_edges(settle(nodes, "tree"), child_of, spouse_of)
    known, who = reach
    local = _held(find(persons, "id", who))
    child_of, spouse_of = _edges(_steps(steps, known))
    nodes = _held(graph.five_tier_nodes(_ids(people, ids), local, child_of, spouse_of, depth, few=True))
    return nodes, graph.induced_edges(nodes, child_of, spouse_of)


def common_ancestors_of(steps: DataFrame, people: DataFrame, pairs: list[tuple[str, str]], limit: int | None = 5, depth: int | None = None) -> DataFrame:
    """As ``graph.common_ancestors``, for a list of pairs over an index."""
    persons = people.select("id", "label", "sex")
    reach = near(steps, sorted({i for p in pairs for i in p}), depth, kinds="U")
    asked = people.sparkSession.createDataFrame(pairs, "a string, b string")
    if reach is None:
        return graph.common_ancestors(asked, _edges(steps)[0], persons, limit, depth)
    known, who = reach
    return graph.common_ancestors(asked, _edges(_steps(steps, known))[0], _held(find(persons, "id", who)), limit, depth, few=True)
