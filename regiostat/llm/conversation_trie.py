"""Conversation prefix trie by truncation peeling.

Every conversation is a path of turns, a turn being the MD5 of its role and
text (128 bits, taken as the turn itself).  Equal paths are merged, then the
paths are sorted, so that the conversations below a node lie side by side.

Peeling.  A *segment* is a run of sorted paths.  From its greatest depth down to
the root, each level takes the nodes that the level below left and the
conversations that end here, groups what agrees in its first ``d`` turns (the
common prefix with the path before is ``d`` or longer), adds up members,
children, leaves and saved tokens, strips the last turn and goes on.  A node
is complete when it is discovered, because all its children are.

Distribution.  Segments are range partitions of the sorted paths, so a first turn
that a third of all conversations share is spread over many.  Only nodes on the
first or the last path of a segment can go on in another one: they stay *open*
and give the sums of their complete part as two *spines* per segment.  Spines of
``arity`` neighbouring segments are peeled in the same way, with new spines as
result, until one segment is left (a logarithmic number of rounds).  Complete
children of open nodes learn their parent's id by joins from the last round back.
No task sees more than a segment, or the spines of ``arity`` segments.

The ids that end at a node are hashed as a stream: sorted in ranges of (path,
id), cut into texts of ids, and these in order put through SHA-256.

Results.  Turns are ordered by turn (null first; ties by role, then by the MD5
of role and text); null role or text is empty.  Rows without a conversation id
belong to no conversation.  Repeated rows are turns like others.  An empty table has
no nodes, not even the root.  The remainder of a negative id is negative.
Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import find_package
from regiostat.session import materialize

#: Bytes of a turn in a path.
TURN = 16
NONE = np.iinfo(np.int64).max
_SHIFT = 20

NODE = "segment bigint, depth bigint, conv bigint, parent bigint, side int, n bigint, children bigint, leaves bigint, saved bigint, ender bigint, n_end bigint"
SPINE = "segment bigint, side int, path binary, words array<bigint>, n array<bigint>, conv array<bigint>, children array<bigint>, leaves array<bigint>, saved array<bigint>, ender array<bigint>, n_end array<bigint>"
LINK = "segment bigint, side int, depth bigint, conv bigint, to_segment bigint, to_side int"
_SUMS = ("n", "conv", "children", "leaves", "saved", "ender", "n_end")


def _struct(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


_NODE, _SPINE, _LINK = _struct(NODE), _struct(SPINE), _struct(LINK)
#: One row of a segment's result: a node, a spine or a link, the others null.
_OUT = pa.schema([("node", pa.struct(list(_NODE))), ("spine", pa.struct(list(_SPINE))), ("link", pa.struct(list(_LINK)))])
OUT = f"node struct<{NODE.replace(' ', ':').replace(',:', ',')}>, spine struct<{SPINE.replace(' ', ':').replace(',:', ',')}>, link struct<{LINK.replace(' ', ':').replace(',:', ',')}>"


def _common(paths: list[bytes]) -> np.ndarray:
    """Turns that each path has in common with the path before (first: 0)."""
    out = np.zeros(len(paths), np.int64)
    for i in range(1, len(paths)):
        a, b = paths[i - 1], paths[i]
        most = min(len(a), len(b))
        if a[:TURN] != b[:TURN]:
            continue
        if a[:most] == b[:most]:
            out[i] = most // TURN
            continue
        x, y = np.frombuffer(a, np.uint64, most // 8), np.frombuffer(b, np.uint64, most // 8)
        out[i] = int((x != y).argmax()) * 8 // TURN
    return out


class Segment:
    """Sorted paths (equal ones may follow each other), and sums that are
    already known at ``depth`` of path ``at``.  ``words`` lists, path after
    path, the words of the last text at depth 0, 1, ..."""

    def __init__(self, paths: list[bytes], words: np.ndarray, at: np.ndarray, depth: np.ndarray, sums: dict[str, np.ndarray]):
        self.paths, self.words = paths, words
        self.length = np.array([len(p) // TURN for p in paths], np.int64)
        self.offset = np.cumsum(self.length + 1) - (self.length + 1)
        self.common = _common(paths)
        order = np.lexsort((at, -depth))
        self.at, self.depth, self.sums = at[order], depth[order], {k: v[order] for k, v in sums.items()}
        self.order = order

    def peel(self, last: bool) -> tuple[dict[str, np.ndarray], list[dict], dict[str, np.ndarray]]:
        """Complete nodes, spines (none if this is the ``last`` segment of
        all), and per given sum the group it went to: its conversation
        (``NONE`` while open) and spine."""
        deepest, m = int(self.length.max()), len(self.paths)
        nodes: dict[str, list[np.ndarray]] = {k: [] for k in ("depth", "parent", "side", *_SUMS)}
        to_conv, to_side = np.full(len(self.at), NONE), np.full(len(self.at), -1, np.int32)
        spines = [] if last else [{k: np.full(int(self.length[i]) + 1, NONE if k in ("conv", "ender") else 0, np.int64) for k in _SUMS} for i in (0, m - 1)]
        first_of_depth = np.searchsorted(-self.depth, -np.arange(deepest + 2), side="left")
        held = {k: np.zeros(0, np.int64) for k in ("at", "complete", *_SUMS)}  # nodes of the level below
        for d in range(deepest, -1, -1):
            here = slice(first_of_depth[d], len(self.at) if d == 0 else first_of_depth[d - 1])
            new = self.at[here]
            position = np.concatenate([held["at"], new])
            order = np.argsort(position, kind="stable")
            position = position[order]
            starts_here = np.ones(len(position), bool)
            starts_here[1:] = (self.common[position[1:]] < d) & (position[1:] != position[:-1])
            start, group = np.flatnonzero(starts_here), np.cumsum(starts_here) - 1
            old = len(held["at"])
            # a complete child counts with its sums, an open one only holds the place
            child = {"n": held["n"], "conv": held["conv"], "children": held["complete"], "leaves": held["leaves"], "saved": held["saved"],
                     "ender": np.full(old, NONE), "n_end": np.zeros(old, np.int64)}
            total = {}
            for k in _SUMS:
                both = np.concatenate([child[k], self.sums[k][here]])[order]
                total[k] = (np.minimum if k in ("conv", "ender") else np.add).reduceat(both, start)
            at = position[start]
            open_side = np.full(len(start), -1, np.int32)
            if not last:
                if self.length[m - 1] >= d:
                    open_side[-1] = 1
                if self.length[0] >= d:
                    open_side[0] = 0
                for g in np.flatnonzero(open_side >= 0):
                    for k in _SUMS:
                        spines[open_side[g]][k][d] = total[k][g]
            group_of = np.empty(len(order), np.int64)
            group_of[order] = group
            # children of this level's nodes learn their parent
            done = np.flatnonzero(held["complete"])
            mine = group_of[:old][done]
            nodes["depth"].append(np.full(len(done), d + 1))
            nodes["parent"].append(np.where(open_side[mine] < 0, total["conv"][mine], NONE))
            nodes["side"].append(open_side[mine])
            for k in _SUMS:
                nodes[k].append(held["own_" + k if "own_" + k in held else k][done])
            to = group_of[old:]
            to_conv[here], to_side[here] = np.where(open_side[to] < 0, total["conv"][to], NONE), open_side[to]
            complete = open_side < 0
            total["leaves"] = np.where(total["children"] == 0, 1, total["leaves"])
            total["saved"] = total["saved"] + np.maximum(total["n"] - 1, 0) * self.words[self.offset[at] + d]
            held = {"at": at, "complete": complete.astype(np.int64), "own_children": total["children"], "own_ender": total["ender"], "own_n_end": total["n_end"]}
            for k in _SUMS:
                held[k] = np.where(complete, total[k], NONE if k in ("conv", "ender") else 0)
        done = np.flatnonzero(held["complete"])
        nodes["depth"].append(np.zeros(len(done), np.int64))
        nodes["parent"].append(np.full(len(done), NONE))
        nodes["side"].append(np.full(len(done), -1, np.int32))
        for k in _SUMS:
            nodes[k].append(held["own_" + k if "own_" + k in held else k][done])
        back_conv, back_side = np.empty_like(to_conv), np.empty_like(to_side)
        back_conv[self.order], back_side[self.order] = to_conv, to_side
        return {k: np.concatenate(v) for k, v in nodes.items()}, spines, {"conv": back_conv, "side": back_side}

    def words_of(self, i: int) -> np.ndarray:
        return self.words[self.offset[i]:self.offset[i] + self.length[i] + 1]


def _rows(node=None, spine=None, link=None) -> pa.RecordBatch:
    n = len(next(x for x in (node, spine, link) if x is not None))
    return pa.RecordBatch.from_arrays([x if x is not None else pa.nulls(n, f.type) for x, f in zip((node, spine, link), _OUT)], schema=_OUT)


def _null(a: np.ndarray) -> pa.Array:
    return pa.array(a, pa.int64(), mask=a == NONE)


def _results(segment: Segment, number: int, last: bool):
    """A peeled segment as record batches of nodes and spines, and where its
    given sums went."""
    nodes, spines, to = segment.peel(last)
    n = len(nodes["depth"])
    out = []
    if n:
        nodes["segment"] = np.full(n, number)
        out.append(_rows(node=pa.StructArray.from_arrays([_null(nodes[f.name]) if f.name != "side" else pa.array(nodes["side"], pa.int32()) for f in _NODE], fields=list(_NODE))))
    if spines:
        # what both spines share is told by the first alone
        spines = spines[:len(segment.paths)]
        ends = (0, len(segment.paths) - 1)
        columns = [pa.array([number] * len(spines), pa.int64()), pa.array(range(len(spines)), pa.int32()), pa.array([segment.paths[i] for i in ends[:len(spines)]], pa.binary()),
                   pa.array([segment.words_of(i) for i in ends[:len(spines)]], pa.list_(pa.int64())), *(pa.array([s[k] for s in spines], pa.list_(pa.int64())) for k in _SUMS)]
        out.append(_rows(spine=pa.StructArray.from_arrays(columns, fields=list(_SPINE))))
    return out, to


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return pa.concat_arrays([x.flatten() for x in column.chunks]).to_numpy(zero_copy_only=False)


def _peel_paths(segment_turns: int):
    """Partitions of sorted merged paths, cut into segments."""
    def segment(rows: list[pa.RecordBatch], number: int):
        table = pa.Table.from_batches(rows).combine_chunks()
        paths = table["path"].to_pylist()
        counts = np.array([len(p) // TURN + 1 for p in paths], np.int64)
        words = np.zeros(int(counts.sum()), np.int64)
        first = np.cumsum(counts) - counts
        inner = np.ones(len(words), bool)
        inner[first] = False
        words[inner] = _flat(table["words"])
        n, ender = table["n"].to_numpy().astype(np.int64), table["ender"].to_numpy().astype(np.int64)
        zero = np.zeros(len(paths), np.int64)
        return _results(Segment(paths, words, np.arange(len(paths)), counts - 1, {"n": n, "conv": ender, "children": zero, "leaves": zero, "saved": zero, "ender": ender, "n_end": n}), number, False)[0]

    def run(batches):
        task, number, held, turns = TaskContext.get().partitionId(), 0, [], 0
        for rows in batches:
            if rows.num_rows:
                held.append(rows)
                turns += rows.num_rows + len(rows.column(rows.schema.get_field_index("words")).flatten())
            if turns >= segment_turns:
                yield from segment(held, (task << _SHIFT) + number)
                held, turns, number = [], 0, number + 1
        if held:
            yield from segment(held, (task << _SHIFT) + number)
    return run


def _peel_spines(arity: int, last: bool):
    """The spines of one group of neighbouring segments."""
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("segment", "ascending"), ("side", "ascending")]).combine_chunks()
        paths, owners, sides = group["path"].to_pylist(), group["segment"].to_numpy(), group["side"].to_numpy()
        counts = np.array([len(p) // TURN + 1 for p in paths], np.int64)
        at = np.repeat(np.arange(len(paths)), counts)
        depth = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
        number = int(group["home"][0].as_py())
        column = lambda k: _flat(group[k]).astype(np.int64)
        out, to = _results(Segment(paths, column("words"), at, depth, {k: column(k) for k in _SUMS}), number, last)
        links = [pa.array(owners[at], pa.int64()), pa.array(sides[at], pa.int32()), pa.array(depth, pa.int64()), _null(to["conv"]), pa.array(np.full(len(at), number), pa.int64()), pa.array(to["side"], pa.int32())]
        out.append(_rows(link=pa.StructArray.from_arrays(links, fields=list(_LINK))))
        return pa.Table.from_batches(out, schema=_OUT)
    return run


def rebuilt(turns: DataFrame, every: int, most: int) -> DataFrame:
    """``conv_id, path, words`` of every conversation: the first ``h`` turns of
    the conversation ``conv_id - conv_id % every``, then its own from ``h`` on;
    ``h`` is the crc32 of the id modulo ``most``.  Only hashes and word counts
    of turns are shuffled."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    mark = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    one = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("bigint").alias("c"), F.struct(F.col("turn"), role.alias("r"), mark.alias("m"), words.alias("w")).alias("x"))
    convs = materialize(one.groupBy("c").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: F.struct(x["m"].alias("m"), x["w"].alias("w"))).alias("x")), "conversations")
    head = convs.where(F.col("c") % every == 0).select(F.col("c").alias("base"), F.slice("x", 1, max(1, most - 1)).alias("head"))
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % most).cast("int")
    both = convs.withColumn("base", F.col("c") - F.col("c") % every).join(head, "base", "left")
    none = F.expr("CAST(array() AS array<struct<m:string,w:bigint>>)")
    turns_of = F.concat(F.coalesce(F.slice("head", F.lit(1), h), none), F.when(F.size("x") > h, F.slice("x", h + 1, F.size("x"))).otherwise(none))
    out = both.select(F.col("c").alias("conv_id"), turns_of.alias("x"))
    return out.select("conv_id", F.unhex(F.array_join(F.transform("x", lambda x: x["m"]), "")).alias("path"), F.transform("x", lambda x: x["w"]).alias("words"))


def ends(convs: DataFrame) -> DataFrame:
    """``ender, sha``: of every path at whose end two conversations or more
    end, the least of them and the hash of all."""
    find_package(convs.sparkSession)
    size = 1 << 16

    def cut(batches):
        for rows in batches:
            key, ids = rows.column(0), rows.column(1).to_numpy().astype(np.int64)
            if not len(ids):
                continue
            whole = key.dictionary_encode()
            code = whole.indices.to_numpy()
            first = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1])]) | (np.arange(len(ids)) % size == 0))
            stop = np.append(first[1:], len(ids))
            yield pa.RecordBatch.from_arrays([key.take(pa.array(first)), pa.array(ids[first]), pa.array(stop - first, pa.int64()), pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in zip(first.tolist(), stop.tolist())])], names=["k", "a", "n", "ids"])

    def stream(batches):
        key, least, n, sha = None, 0, 0, None
        for rows in batches:
            out = []
            for k, a, many, ids in zip(*(c.to_pylist() for c in rows.columns)):
                if k != key:
                    if n > 1:
                        out.append((least, sha.hexdigest()))
                    key, least, n, sha = k, a, 0, hashlib.sha256()
                sha.update(("," if n else "").encode() + ids.encode())
                n += many
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], names=["ender", "sha"])
        if n > 1:
            yield pa.RecordBatch.from_arrays([pa.array([least], pa.int64()), pa.array([sha.hexdigest()])], names=["ender", "sha"])

    keyed = convs.select(F.unhex(F.md5("path")).alias("k"), F.col("conv_id").alias("a"))
    cuts = keyed.repartitionByRange("k", "a").sortWithinPartitions("k", "a").mapInArrow(cut, "k binary, a bigint, n bigint, ids string")
    return cuts.repartition("k").sortWithinPartitions("k", "a").mapInArrow(stream, "ender bigint, sha string")


def trie(turns: DataFrame, every: int = 20, most: int = 4, segment_turns: int = 400_000, arity: int = 64) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` of every node of the trie of the rebuilt
    conversations."""
    spark = turns.sparkSession
    find_package(spark)
    convs = materialize(rebuilt(turns, every, most), "paths")
    merged = materialize(convs.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("ender"), F.first("words").alias("words")), "merged")
    turns_kept = merged.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    parts = max(1, 2 * (-(-turns_kept // segment_turns)), min(spark.sparkContext.defaultParallelism, turns_kept // 20_000))
    ordered = merged.repartitionByRange(int(parts), "path").sortWithinPartitions("path")
    level = materialize(ordered.mapInArrow(_peel_paths(segment_turns), OUT), "peeled")
    levels = [level]
    group = F.shiftright("segment", _SHIFT)
    while True:
        spines = levels[-1].where("spine IS NOT NULL").select("spine.*")
        bound = spines.agg(F.max(group)).first()[0]
        if bound is None:  # no conversations
            break
        last = bound < arity
        homes = spines.withColumn("home", F.shiftleft((group / arity).cast("bigint"), _SHIFT))
        levels.append(materialize(homes.groupBy("home").applyInArrow(_peel_spines(arity, last), OUT), "peeled"))
        if last:
            break
    # from the last round back: the conversation of every open node
    known, nodes = None, None
    for level in reversed(levels):
        mine = level.where("node IS NOT NULL").select("node.*")
        if known is not None:
            up = known.select("segment", "side", (F.col("depth") + 1).alias("depth"), F.col("conv").alias("up"))
            mine = mine.join(up, ["segment", "side", "depth"], "left").withColumn("parent", F.coalesce("parent", "up")).select(*[f.name for f in _NODE])
        nodes = mine if nodes is None else nodes.unionByName(mine)
        links = level.where("link IS NOT NULL").select("link.*")
        if known is not None:
            over = known.select(F.col("segment").alias("to_segment"), F.col("side").alias("to_side"), "depth", F.col("conv").alias("up"))
            links = links.join(over, ["to_segment", "to_side", "depth"], "left").withColumn("conv", F.coalesce("conv", "up"))
        known = links.select("segment", "side", "depth", "conv")
    sha = ends(convs)
    alone = F.sha2(F.when(F.col("n_end") > 0, F.col("ender").cast("string")).otherwise("").cast("binary"), 256)
    return nodes.join(sha, "ender", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.when(F.col("n_end") > 1, F.col("sha")).otherwise(alone).alias("ends_sha256"))


def oracle(every: int = 20, most: int = 4) -> str:
    """The trie in DuckDB SQL: nodes are lists of turns, subtrees are found by
    their first turns (for small tables)."""
    crc = ("xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::BIGINT), "
           "lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")
    return rf"""
WITH one AS (
  SELECT conv_id AS c, CAST(conv_id AS VARCHAR) AS s, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT c, s, list({{'m': md5(octet_length(encode(r)) || ':' || r || t), 'w': CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT)}}
                    ORDER BY turn NULLS FIRST, r, md5(octet_length(encode(r)) || ':' || r || t)) AS x FROM one GROUP BY c, s),
paths AS (
  SELECT a.c, list_concat(coalesce(b.x[1:h], []), a.x[h + 1:]) AS p
  FROM (SELECT *, CAST({crc} % {most} AS BIGINT) AS h FROM own) a LEFT JOIN own b ON b.c = a.c - a.c % {every}),
members AS (
  SELECT c, d, list_transform(p[1:d], lambda v: v.m) AS k, CASE WHEN d > 0 THEN p[d].w ELSE 0 END AS w, d = len(p) AS ends
  FROM (SELECT c, p, unnest(range(0, len(p) + 1)) AS d FROM paths)),
nodes AS (
  SELECT d, k, min(c) AS c, count(*) AS n, (count(*) - 1) * min(w) AS own_saved, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS sha
  FROM members GROUP BY d, k),
shape AS (
  SELECT a.*, p.c AS parent, coalesce(q.n_children, 0) AS n_children
  FROM nodes a LEFT JOIN nodes p ON p.d = a.d - 1 AND p.k = a.k[1:a.d - 1]
  LEFT JOIN (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL) q ON q.d = a.d AND q.k = a.k),
below AS (
  SELECT d, k[1:d] AS k, sum(own_saved) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
  FROM (SELECT k, own_saved, n_children, unnest(range(0, d + 1)) AS d FROM shape) GROUP BY 1, 2)
SELECT s.c AS conv_id, s.d AS depth, s.parent AS parent_conv_id, s.n AS n_convs, CAST(s.n_children AS BIGINT) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, s.sha AS ends_sha256
FROM shape s JOIN below b ON b.d = s.d AND b.k = s.k"""
