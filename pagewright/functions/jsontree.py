"""Embedded JSON as a flat node array.

Spark's own JSON readers either fix the schema, sort the keys or stop at a fixed depth, and a
recursive query would materialize every level of every page. One Arrow-batched helper therefore
turns the JSON texts of a page into one array of nodes; all rules about what the nodes mean are
Spark expressions over that array, so a page never leaves its partition.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagewright.functions import text as tx

NODE = "struct<blob:int,pos:int,up:int,key:string,kind:string,text:string,first:int,size:int>"
NODE_ARRAY = f"array<{NODE}>"
SCALARS = ("str", "num", "bool")
SKIPPED = -2

# Pages turned into nodes at a time, which bounds the memory of a Python worker.
PAGES_AT_ONCE = 64

_NODE_FIELDS = ("blob", "pos", "up", "key", "kind", "text", "first", "size")
_KINDS = {str: "str", bool: "bool", int: "num", float: "num", dict: "dict", list: "list"}


def _parse(texts, too_deep=None):
    """(index, value) of the texts that are JSON. Those nested too deeply to be read go to ``too_deep``."""
    for index, text in enumerate(texts or ()):
        try:
            yield index, json.loads(text)
        except (ValueError, TypeError):
            continue
        except RecursionError:
            if too_deep is not None:
                too_deep.append(index)


def _nodes(parsed, too_deep, keep_json):
    """Node columns of one page from what :func:`_parse` gave. Siblings are neighbours in the array (``first``,
    ``size`` address the children of a node, ``up`` its parent); ``pos`` is the rank in document order. A text
    that is nested too deeply is one node of kind ``skipped`` whose ``up`` is SKIPPED."""
    blobs, values = [b for b, _ in parsed], [v for _, v in parsed]
    keys, ups, firsts, sizes = [None] * len(values), [-1] * len(values), [], []
    at = 0
    while at < len(values):
        value = values[at]
        nested = type(value) in (dict, list)
        sizes.append(len(value) if nested else 0)
        firsts.append(len(values) if nested else 0)
        if nested:
            keys.extend(value if type(value) is dict else [None] * len(value))
            values.extend(value.values() if type(value) is dict else value)
            ups.extend([at] * len(value))
            blobs.extend([blobs[at]] * len(value))
        at += 1

    weight = [1] * len(values)
    for at in range(len(values) - 1, -1, -1):
        if ups[at] >= 0:
            weight[ups[at]] += weight[at]
    pos, cursor, top = [], [], 0
    for at, up in enumerate(ups):
        here = top if up < 0 else cursor[up]
        if up < 0:
            top += weight[at]
        else:
            cursor[up] += weight[at]
        pos.append(here)
        cursor.append(here + 1)

    kinds = [_KINDS.get(type(v), "null") for v in values]
    texts_out = [
        str(v) if kind in SCALARS
        else json.dumps(v, ensure_ascii=False) if v is not None and key is not None and key.lower() in keep_json
        else None
        for v, kind, key in zip(values, kinds, keys)
    ]
    for index in too_deep:
        row = (index, -1, SKIPPED, None, "skipped", None, 0, 0)
        for column, value in zip((blobs, pos, ups, keys, kinds, texts_out, firsts, sizes), row):
            column.append(value)
    return blobs, pos, ups, keys, kinds, texts_out, firsts, sizes


def _strings(values) -> pa.Array:
    try:
        return pa.array(values, pa.string())
    except UnicodeEncodeError:  # lone surrogates from \\ud800 escapes
        return pa.array(
            [v if v is None else v.encode("utf-8", "replace").decode() for v in values], pa.string()
        )


def json_nodes(texts: Column, keep_json=()) -> Column:
    """Node array of an array of JSON texts; texts that are not JSON are skipped.

    A container node carries its JSON text only when its lower-cased key is in ``keep_json``.
    """
    return node_reader(keep_json)(texts)


def node_reader(keep_json=()):
    """The function behind :func:`json_nodes`, which a session can register."""
    wanted = frozenset(key.lower() for key in keep_json)

    @F.arrow_udf(NODE_ARRAY)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for start in range(0, len(batch), PAGES_AT_ONCE):
                yield _node_array(map(_parsed, batch.slice(start, PAGES_AT_ONCE).to_pylist()), wanted)

    return read


def _parsed(texts) -> tuple[list, list]:
    too_deep = []
    return list(_parse(texts, too_deep)), too_deep


def _node_array(pages, keep_json) -> pa.Array:
    """Node arrays of a few pages (pairs of parsed texts and those too deep), built column by column."""
    columns, offsets = [[] for _ in _NODE_FIELDS], [0]
    for parsed, too_deep in pages:
        for column, part in zip(columns, _nodes(parsed, too_deep, keep_json)):
            column.extend(part)
        offsets.append(len(columns[0]))
    arrays = [
        _strings(column) if name in ("key", "kind", "text") else pa.array(column, pa.int32())
        for name, column in zip(_NODE_FIELDS, columns)
    ]
    structs = pa.StructArray.from_arrays(arrays, names=list(_NODE_FIELDS))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)


def payload_json(text: Column) -> Column:
    """struct<nodes, canonical> of one JSON text each: its node array, and the text with sorted keys and default
    separators, NULL when it is not JSON. A text is parsed once, by one worker, a few texts at a time."""

    @F.arrow_udf(f"struct<nodes:{NODE_ARRAY},canonical:string>")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for start in range(0, len(batch), PAGES_AT_ONCE):
                pages = [_parsed([t]) for t in batch.slice(start, PAGES_AT_ONCE).to_pylist()]
                texts = [
                    next((json.dumps(v, sort_keys=True, ensure_ascii=False) for _, v in parsed), None)
                    for parsed, _ in pages
                ]
                arrays = [_node_array(pages, frozenset()), _strings(texts)]
                yield pa.StructArray.from_arrays(arrays, names=["nodes", "canonical"])

    return read(text)


# The rules over node arrays nest deeply, so they are written as SQL text: the functions below build
# the text of an expression from the texts of its parts.

IS_SCALAR = "{0}.kind IN ('str', 'num', 'bool')"


def children(nodes: str, node: str) -> str:
    """Child nodes of the variable ``node``."""
    return f"slice({nodes}, {node}.first + 1, {node}.size)"


def member(nodes: str, node: str, key: str) -> str:
    """The value node under an object's key (exact case), NULL when absent or not an object."""
    return f"get(filter({children(nodes, node)}, child -> child.key = '{key}'), 0)"


def skipped(nodes: str) -> str:
    """How many JSON texts were nested too deeply to be read."""
    return f"size(filter({nodes}, node -> node.up = {SKIPPED}))"


def roots(nodes: str) -> str:
    return f"filter({nodes}, node -> node.up = -1)"


def truthy(node: str) -> str:
    """Whether the variable ``node`` is non-zero, non-empty, not null and not false."""
    return (
        f"CASE {node}.kind WHEN 'bool' THEN {node}.text = 'True'"
        f" WHEN 'num' THEN {node}.text NOT IN ('0', '0.0', '-0.0')"
        f" WHEN 'str' THEN {node}.text <> ''"
        f" WHEN 'dict' THEN {node}.size > 0 WHEN 'list' THEN {node}.size > 0 ELSE false END"
    )


def truthy_text(node: str) -> str:
    """Text of a truthy scalar, else NULL."""
    return tx.sql_let(node, "t", f"CASE WHEN {IS_SCALAR.format('t')} AND {truthy('t')} THEN t.text END")


def scalar_text(node: str) -> str:
    """Trimmed text of a scalar that is not blank, else NULL."""
    text = f"CASE WHEN {IS_SCALAR.format('s')} THEN s.text END"
    return tx.sql_let(node, "s", tx.sql_non_empty(tx.sql_strip(text)))


# The helpers travel to the workers as code, so that these need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
