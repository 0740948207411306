"""Deeply nested records into related flat tables.

Each record is walked once as a stream of (path, ordinals, value) triples. The triples are grouped by
their repeated ancestor (the list whose element they belong to) and each group is pivoted into the row
of one table. A record is whole in its row, so grouping and pivoting need no shuffle; only the removal
of records delivered twice does, and it moves the pivoted groups that are asked for rather than the JSON.
Levels below the deepest one asked for aren't walked.

Where the levels aren't known, ``ancestors`` finds them from the paths of all records: a path up to its last
list is a group, whatever its depth, and ``group_table`` pivots any one group.

Defined cases: a null, empty or unparsable payload, or one without the root list, gives no rows (see
``Shredded.errors``); a null list is an empty list; a lone object counts as a list of one; a list or
object written as a JSON string is read as what it holds; a null element takes its position but gives
no row; elements that are neither object nor null are skipped in the same way; keys are compared
without case and punctuation; of equal keys in one object the last counts; the list of the next level may
stand in an object that no level names, at any depth.
"""

from __future__ import annotations

import json
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.frames import first_per_key

_STRINGS, _INTS = pa.list_(pa.string()), pa.list_(pa.int32())


@dataclass(frozen=True)
class Level:
    """A repeated ancestor: the key of its list, and (column, key, kind) of the fields of its rows.

    Kinds: ``text``, ``int``, ``texts``, ``ints``, ``json`` or ``at<i>``/``iat<i>`` for one place of a list.
    """

    name: str
    list_key: str
    fields: tuple[tuple[str, str, str], ...]


#: The fields of the response itself, beside its root list.
ROOT = Level("response", "", (("doc_id", "docid", "text"), ("dob", "dob", "text"), ("gender", "gender", "text"), ("age", "age", "text")))
CLINICAL = (
    Level("section", "content", (("id", "id", "text"), ("text", "text", "at0"), ("text_begin", "text", "iat1"), ("text_end", "text", "iat2"), ("sentence", "sentence", "ints"), ("section_offset", "sectionoffset", "ints"), ("section_oid", "sectionoid", "text"), ("aspect", "aspect", "text"), ("name", "name", "text"), ("attributes", "attributes", "json"))),
    Level("concept", "umlsconcepts", (("cui", "cui", "text"), ("tui", "tui", "texts"), ("preferred_text", "preferredtext", "text"))),
    Level("sab", "sabconcepts", (("coding_scheme", "codingscheme", "text"),)),
    Level("vocab", "vocabconcepts", (("code", "code", "text"), ("tty", "tty", "texts"))),
)
#: The fields that name a node, one a level.
CLINICAL_KEYS = tuple(Level(x.name, x.list_key, ((x.fields[0][0], x.fields[0][1], x.fields[0][2]),)) for x in CLINICAL)


def positions(levels: tuple[Level, ...]) -> tuple[str, ...]:
    """The columns that hold the places of a node and of its ancestors."""
    return tuple(f"{x.name}_pos" for x in levels)


def plain(key: str, known: dict[str, str] = {}) -> str:  # noqa: B006 - the spellings met so far
    k = known.get(key)
    if k is None:
        k = "".join(c for c in key.lower() if c.isalnum())
        if len(known) < 10_000:
            known[key] = k
    return k


def opened(value: object) -> object:
    """A container that was written as a JSON string, as a container."""
    if isinstance(value, str):
        s = value.strip()
        if s[:1] in ("[", "{"):
            try:
                return json.loads(s)
            except ValueError:
                return value
    return value


def roots_of(record: object, root_key: str) -> Iterator[dict]:
    """The objects that hold a root list, looked for in all lists and envelopes around them, nearest first."""
    todo, met = deque([opened(record)]), False
    while todo:
        x = todo.popleft()
        if isinstance(x, dict) and any(plain(k) == root_key for k in x):
            met = True
            yield x
        elif isinstance(x, (list, dict)):
            for v in x if isinstance(x, list) else x.values():
                try:
                    o = opened(v)
                except RecursionError:
                    if not met:
                        raise
                    continue
                if isinstance(o, (dict, list)):
                    todo.append(o)


def triples(record: object, levels: tuple[Level, ...]) -> Iterator[tuple[tuple[str, ...], tuple[int, ...], object]]:
    """(path, ordinals, value) of each leaf in document order.

    Each list of a level adds its key to the path and its position to the ordinals; an object of a level
    first gives a triple with the bare path and no value, so that objects without fields aren't lost.
    Whatever no level names is a leaf; if it is an object, lists of the next level are looked for in it. Of
    several roots the positions in the root lists are counted on.
    """
    depth = {x.list_key: i for i, x in enumerate(levels)}
    shift, deepest = 0, len(levels)
    for root in roots_of(record, levels[0].list_key):
        stack: list[tuple[tuple[str, ...], tuple[int, ...], dict, bool]] = [((), (), root, False)]
        yield (), (), None
        following = shift
        while stack:
            path, at, node, inner = stack.pop()
            later = []
            for key, value in node.items():
                k = plain(key)
                if depth.get(k, -1) == len(at):
                    value = opened(value)
                    whole = (*path, k)
                    elements = value if isinstance(value, list) else [value]
                    if not at:
                        following = max(following, shift + len(elements))
                    for i, element in enumerate(elements, 0 if at else shift):
                        element = opened(element)
                        if isinstance(element, dict):
                            yield whole, (*at, i), None
                            later.append((whole, (*at, i), element, False))
                    continue
                if not inner:
                    yield (*path, k), at, value
                if at and len(at) < deepest and isinstance(value, dict):
                    later.append((path, at, value, True))
            stack.extend(reversed(later))
        shift = following


def _text(v: object) -> str | None:
    if v is None or isinstance(v, str):
        return v
    if isinstance(v, bool):
        return "true" if v else "false"
    return json.dumps(v, ensure_ascii=False) if isinstance(v, (dict, list, float)) else str(v)


def _int(v: object) -> int | None:
    try:
        n = int(v)  # type: ignore[call-overload]
        return n if -(2**31) <= n < 2**31 else None
    except (TypeError, ValueError, OverflowError):
        return None


def _listed(v: object) -> list:
    return [] if v is None else v if isinstance(v, list) else [v]


def _cell(kind: str, v: object) -> object:
    if kind == "text":
        return _text(v)
    if kind == "texts":
        return [_text(x) for x in _listed(v)]
    if kind == "int":
        return _int(v)
    if kind == "ints":
        return [_int(x) for x in _listed(v)]
    if kind == "json":
        return None if v is None else json.dumps(v, ensure_ascii=False)
    i = int(kind.lstrip("iat"))
    x = v[i] if isinstance(v, list) and len(v) > i else v if i == 0 and not isinstance(v, list) else None
    return _int(x) if kind[0] == "i" else _text(x)


_ARROW = {"text": pa.string(), "texts": _STRINGS, "int": pa.int32(), "ints": _INTS, "json": pa.string()}
_DDL = {"text": "string", "texts": "array<string>", "int": "int", "ints": "array<int>", "json": "string"}


def _kind(kind: str, table: dict) -> object:
    return table["int" if kind[:3] == "iat" else "text" if kind[:2] == "at" else kind]


def pivot(record: object, levels: tuple[Level, ...], root: Level | None = None) -> list[list[dict]]:
    """For each level, behind ``root`` if given, its rows: positions, and the fields found beside the same ordinals."""
    places = positions(levels)
    tables: list[dict[tuple[int, ...], dict]] = [{} for _ in levels]
    roots: list[dict] = []
    wanted: list[dict[str, list[tuple[str, str]]]] = []
    for x in (root or Level("", "", ()), *levels):
        by: dict[str, list[tuple[str, str]]] = {}
        for column, key, kind in x.fields:
            by.setdefault(key, []).append((column, kind))
        wanted.append(by)
    for path, at, value in triples(record, levels):
        n = len(at)
        if len(path) == n:
            if n:
                tables[n - 1][at] = dict(zip(places, at))
            else:
                roots.append({"response_pos": len(roots)})
        elif len(path) == n + 1:
            row = tables[n - 1][at] if n else roots[-1]
            for column, kind in wanted[n].get(path[-1], ()):
                row[column] = _cell(kind, value)
    out = [list(t.values()) for t in tables]
    return [roots, *out] if root else out


def shred(df: DataFrame, key: str, payload: str, order: list[Column], levels: tuple[Level, ...] = CLINICAL, keep: tuple[str, ...] | None = None, root: Level | None = None) -> DataFrame:
    """One row per record: ``key``, one array of rows per level, ``error``.

    ``order`` says which of several deliveries of a key counts. ``keep`` names the levels whose rows are
    wanted (all by default). Parsing comes before the removal of repeated deliveries, so that only the
    pivoted groups are shuffled.
    """
    shown = (*((root,) if root else ()), *levels)
    held = [i for i, x in enumerate(shown) if keep is None or x.name in keep]
    walked = levels[: max([1, *(levels.index(shown[i]) + 1 for i in held if shown[i] is not root)])]
    places = positions(levels)
    columns = [["response_pos"] if shown[i] is root else list(places[: levels.index(shown[i]) + 1]) for i in held]
    kinds = [pa.list_(pa.struct([*[(c, pa.int32()) for c in cs], *[(c, _kind(k, _ARROW)) for c, _, k in shown[i].fields]])) for i, cs in zip(held, columns)]
    ddl = [f"{shown[i].name} array<struct<{','.join([f'{c}:int' for c in cs] + [f'`{c}`:{_kind(k, _DDL)}' for c, _, k in shown[i].fields])}>>" for i, cs in zip(held, columns)]
    base = df.select(F.col(key).alias("__key"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("__order"), F.col(payload).cast("string").alias("__payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in held]
            errors: list[str | None] = []
            for text in b.column(2).to_pylist():
                rows, error = None, None
                if text is None or not text.strip():
                    error = "empty"
                else:
                    try:
                        record = json.loads(text)
                        rows = pivot(record, walked, root)
                        if next(roots_of(record, levels[0].list_key), None) is None:
                            error = "no root list"
                    except ValueError as e:
                        error = f"not JSON: {e}"[:200]
                    except RecursionError:
                        error = "nested too deeply"
                for o, i in zip(out, held):
                    o.append(rows[i] if rows else [])
                errors.append(error)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(o, t) for o, t in zip(out, kinds)], pa.array(errors, pa.string())], names=["__key", "__order", *[shown[i].name for i in held], "error"])

    schema = f"__key {base.schema['__key'].dataType.simpleString()}, __order {base.schema['__order'].dataType.simpleString()}, {', '.join(ddl)}, error string"
    parsed = base.mapInArrow(run, schema)
    return first_per_key(parsed, "__key", [F.col("__order")]).select(F.col("__key").alias(key), *[shown[i].name for i in held], "error")


# ---- levels found from the paths


def walk(record: object) -> Iterator[tuple[tuple[str, ...], tuple[int, ...], object]]:
    """(path, ordinals, value) of each leaf and, with no value, of each element of a list, in document order; ``[]`` stands in the path for a list's element."""
    stack: list[tuple[tuple[str, ...], tuple[int, ...], object]] = [((), (), record)]
    while stack:
        path, at, node = stack.pop()
        node = opened(node)
        if isinstance(node, dict):
            stack.extend(((*path, plain(k)), at, v) for k, v in reversed(node.items()))
        elif isinstance(node, list):
            stack.extend(((*path, "[]"), (*at, i), v) for i, v in reversed(list(enumerate(node))))
        if isinstance(node, dict) and path[-1:] == ("[]",):
            yield path, at, None
        elif not isinstance(node, (dict, list)):
            yield path, at, node


def split_path(path: tuple[str, ...]) -> tuple[str, str]:
    """A path as its repeated ancestor (up to its last list) and the column below it."""
    k = max((i + 1 for i, x in enumerate(path) if x == "[]"), default=0)
    return ".".join(path[:k]).replace(".[]", "[]"), ".".join(path[k:])


def _loaded(text: str | None) -> object:
    try:
        return json.loads(text) if text else None
    except (ValueError, RecursionError):
        return None


def ancestors(df: DataFrame, payload: str) -> DataFrame:
    """ancestor, column, n: the groups of paths of all records, and how often each column has a value.

    Counted in Arrow batches before the shuffle; what is shuffled is the schema, not the records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter = Counter()
            for text in b.column(0).to_pylist():
                seen.update(split_path(path) for path, _, _ in walk(_loaded(text)) if path)
            names, counts = zip(*seen.items()) if seen else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in names], pa.string()), pa.array([x[1] for x in names], pa.string()), pa.array(counts, pa.int64())], names=["ancestor", "column", "n"])

    return df.select(F.col(payload).cast("string")).mapInArrow(run, "ancestor string, column string, n long").groupBy("ancestor", "column").agg(F.sum("n").alias("n"))


def group_table(df: DataFrame, key: str, payload: str, order: list[Column], ancestor: str) -> DataFrame:
    """key, ordinals, parent (the ordinals of the element around), fields (column to text): the rows of one group."""
    base = df.select(F.col(key).alias("__key"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("__order"), F.col(payload).cast("string").alias("__payload"))
    kind = pa.list_(pa.struct([("ordinals", pa.list_(pa.int32())), ("fields", pa.map_(pa.string(), pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column(2).to_pylist():
                rows: dict[tuple[int, ...], dict] = {}
                for path, at, value in walk(_loaded(text)):
                    group, column = split_path(path)
                    if group == ancestor:
                        row = rows.setdefault(at, {})
                        if column or value is not None:
                            row[column] = _text(value)
                out.append([{"ordinals": list(at), "fields": list(r.items())} for at, r in rows.items()])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, kind)], names=["__key", "__order", "rows"])

    schema = f"__key {base.schema['__key'].dataType.simpleString()}, __order {base.schema['__order'].dataType.simpleString()}, rows array<struct<ordinals:array<int>,fields:map<string,string>>>"
    one = first_per_key(base.mapInArrow(run, schema).withColumn("rows", F.transform("rows", lambda r: F.struct(r["ordinals"].alias("ordinals"), F.map_entries(r["fields"]).alias("fields")))), "__key", [F.col("__order")])
    return one.select(F.col("__key").alias(key), F.explode("rows").alias("r")).select(key, "r.ordinals", F.expr("slice(r.ordinals, 1, greatest(size(r.ordinals) - 1, 0))").alias("parent"), F.map_from_entries("r.fields").alias("fields"))


@dataclass(frozen=True)
class Shredded:
    """The flat tables of a shredded frame. A child row carries the positions of its parent."""

    frame: DataFrame
    key: str
    levels: tuple[Level, ...] = CLINICAL

    def table(self, name: str) -> DataFrame:
        return self.frame.select(self.key, F.explode(name).alias("r")).select(self.key, "r.*")

    def errors(self) -> DataFrame:
        return self.frame.filter(F.col("error").isNotNull()).select(self.key, "error")

    def nodes(self) -> DataFrame:
        """All objects of all levels in one pass: key, level, positions (-1 below), node_key."""
        def listed(i: int, x: Level) -> Column:
            label, places = x.fields[0][0], positions(self.levels)
            return F.transform(x.name, lambda r: F.struct(F.lit(x.name).alias("level"), *[(r[p] if j <= i else F.lit(-1)).cast("int").alias(p) for j, p in enumerate(places)], F.coalesce(r[label], F.lit("")).alias("node_key")))

        parts = [listed(i, x) for i, x in enumerate(self.levels)]
        return self.frame.select(self.key, F.explode(F.concat(*parts)).alias("n")).select(self.key, "n.*")
