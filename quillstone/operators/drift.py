"""Schemas that drift between files (problem 4): tagged-union inference over JSON files of a feed.

Every file's schema is inferred in parallel as a map path -> set of JSON types (a tagged union: no alternative is
thrown away). The unions of all files are fused into one consistent layout in which a path with conflicting types is
split into a branch for each type plus a canonical column, and consecutive files are compared to report each change.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows
from quillstone.operators.nested import json_type, parse_json

#: Buckets of the hashed content sketch: words, value shapes and magnitudes of a path's values.
SKETCH = 512
#: A removed and an added path are one renamed path from this similarity of content, or from the lower one when the
#: names of the keys are alike too.
SAME_CONTENT, ALIKE_CONTENT, ALIKE_NAME = 0.55, 0.3, 0.34
#: Booleans have too little content to tell two fields apart: their keys must be alike.
OPAQUE = frozenset({"boolean"})

#: Values whose features a task remembers, and feature counters it holds before it hands them on.
REMEMBERED, HELD = 50_000, 2_000_000

# The JSON types, by number.
TYPES = ("null", "string", "number", "boolean", "array", "object")

PROFILE = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("file_seq", T.IntegerType()),
        T.StructField("path", T.StringType()),
        T.StructField("types", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.BinaryType()),
    ]
)

CHANGES = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("file_seq", T.IntegerType()),
        T.StructField("change", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("new_field", T.StringType()),
    ]
)

_WORD, _DIGITS, _RUN = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"a(?:\s+a)+")


def _features(kind: str, value) -> list[str]:
    """What a single value adds to its path's sketch: its whole shape (runs of words as one) and every word, or its magnitude."""
    if kind == "string":
        words = _WORD.findall(value.lower())
        shape = _RUN.sub("a", _DIGITS.sub("9", _WORD.sub("a", value)))
        return [f"s:{shape}", *[f"w:{w}" for w in words], f"l:{len(value).bit_length()}"]
    if kind == "number":
        size = 0 if value == 0 else int(math.floor(math.log10(abs(value)) * 3))
        return [f"n:{size}", f"i:{float(value).is_integer()}", f"d:{len(repr(value))}"]
    if kind == "boolean":
        return [f"b:{value}"]
    return []


class _Features(dict):
    """Sketch cells of values, remembered: (number of the path's type, type of the value, value) -> cells."""

    def __missing__(self, key: tuple) -> list[int]:
        if len(self) > REMEMBERED:
            self.clear()
        of, kind, value = key
        found = [of * SKETCH + zlib.crc32(f.encode("utf-8", "replace")) % SKETCH for f in _features(kind, value)]
        if not isinstance(value, str) or len(value) < 200:
            self[key] = found
        return found


def walk(root: dict, paths: dict[str, tuple[list[int], Counter]], features: _Features) -> int:
    """Adds a parsed record to the types and sketches of its paths; returns how many cells were counted."""
    stack, n = [(root, "")], 0
    while stack:
        here, at = stack.pop()
        for key, child in here.items():
            p = f"{at}.{key}" if at else key
            kind = json_type(child)
            number = TYPES.index(kind)
            cell = paths.get(p)
            if cell is None:
                cell = paths[p] = [0] * len(TYPES), Counter()
            cell[0][number] += 1
            items = [child]
            while kind == "array" and any(isinstance(x, list) for x in items):  # arrays of arrays are entered too
                if len(items) == 1 and items[0] is child:
                    p += "[]"
                items = [y for x in items if isinstance(x, list) for y in x] + [x for x in items if not isinstance(x, list)]
            for x in items:
                if isinstance(x, dict):
                    stack.append((x, p))
                    found = [number * SKETCH + zlib.crc32(f"k:{k}".encode("utf-8", "replace")) % SKETCH for k in x]
                elif x is not None:
                    found = features[number, json_type(x), x]
                else:
                    continue
                cell[1].update(found)
                n += len(found)
    return n


def pack(sketch: dict[int, int]) -> bytes:
    """A sketch as bytes: its cells in order, then their counts (the shuffle compresses them)."""
    cells = sorted(sketch)
    return array("H", cells).tobytes() + array("Q", [sketch[c] for c in cells]).tobytes()


def unpack(payload: bytes) -> dict[int, int]:
    n = len(payload) // 10
    cells, counts = array("H"), array("Q")
    cells.frombytes(payload[: 2 * n])
    counts.frombytes(payload[2 * n :])
    return dict(zip(cells, counts))


def profile(records: DataFrame) -> DataFrame:
    """(feed, file_seq, path, types, sketch): how often a path has each of TYPES in a file, and its content sketch.

    One packed row a file and path: partial ones are made within each task and added up behind one shuffle, a row at
    a time, so what moves is bounded by tasks x files x paths, whatever the number of records; a feed that holds a
    third of all rows costs no more in the shuffle than any other. Null, empty and broken JSON count as an empty record.
    """

    def rows(source):
        files: dict[tuple, dict] = {}
        features, n = _Features(), 0

        def handed():
            for (feed, seq), paths in files.items():
                for path, (types, sketch) in paths.items():
                    yield feed, seq, path, types, pack(sketch)

        for feed, seq, text in source:
            root = parse_json(text)
            if isinstance(root, dict):
                n += walk(root, files.setdefault((feed, seq), {}), features)
            if n > HELD:
                yield from handed()
                files, n = {}, 0
        yield from handed()

    def merged(source):
        now, types, sketch = None, [], Counter()
        for feed, seq, path, more, payload in source:
            if (feed, seq, path) != now:
                if now is not None:
                    yield *now, types, pack(sketch)
                now, types, sketch = (feed, seq, path), [0] * len(TYPES), Counter()
            types = [x + y for x, y in zip(types, more)]
            for cell, count in unpack(payload).items():
                sketch[cell] += count
        if now is not None:
            yield *now, types, pack(sketch)

    parts = map_rows(records.select("feed", F.col("file_seq").cast("int"), "json_data"), PROFILE, rows, batch=2_000)
    keys = ["feed", "file_seq", "path"]
    return map_rows(parts.repartition(*keys).sortWithinPartitions(*keys), PROFILE, merged, batch=2_000)


def _tokens(key: str) -> set[str]:
    return {t for t in re.split(r"[_\W]+", re.sub(r"([a-z])([A-Z])", r"\1_\2", key).lower()) if t}


def name_similarity(a: str, b: str) -> float:
    """Shared words of two keys, a word being shared also when one is the other's beginning."""
    x, y = _tokens(a), _tokens(b)
    if not x or not y:
        return 0.0
    hit = lambda s, t: sum(any(u == v or min(len(u), len(v)) >= 3 and (u.startswith(v) or v.startswith(u)) for v in t) for u in s)
    return (hit(x, y) + hit(y, x)) / (len(x) + len(y))


def cosine(a: dict[int, float], b: dict[int, float]) -> float:
    """Cosine of two sketches with damped counts, so that one frequent value does not decide alone."""
    dot = sum(math.sqrt(v) * math.sqrt(b[k]) for k, v in a.items() if k in b)
    return dot / math.sqrt(sum(a.values()) * sum(b.values())) if a and b else 0.0


def _parent(path: str) -> str:
    return path.rpartition(".")[0]


def _ancestors(path: str) -> list[str]:
    parts = path.split(".")
    out = []
    for i in range(1, len(parts)):
        whole = ".".join(parts[:i])
        out.append(whole[:-2] if whole.endswith("[]") else whole)
    return out


def compare(old: dict[str, dict], new: dict[str, dict]) -> list[tuple[str, str, str]]:
    """(change, field, new_field) between the unions of two files; each union maps a path to its types and sketch."""
    types = lambda e: e["types"] - {"null"}
    gone, come = set(old) - set(new), set(new) - set(old)
    changed = {p for p in set(old) & set(new) if types(old[p]) and types(new[p]) and types(old[p]) != types(new[p])}
    moved = gone | come | changed
    top = lambda p: not any(a in moved for a in _ancestors(p))
    gone, come, changed = {p for p in gone if top(p)}, {p for p in come if top(p)}, {p for p in changed if top(p)}
    scored = []
    for a in gone:
        for b in come:
            if _parent(a) != _parent(b):
                continue
            x, y = types(old[a]), types(new[b])
            if x != y and x and y:
                continue
            content, name = cosine(unpack(old[a]["sketch"]), unpack(new[b]["sketch"])), name_similarity(a.rpartition(".")[2], b.rpartition(".")[2])
            if not x or not y:
                content = 0.0
            sure = content >= SAME_CONTENT and not (x <= OPAQUE) or content >= ALIKE_CONTENT and name >= ALIKE_NAME
            if sure:
                scored.append((content + name, a, b))
    out = []
    for _, a, b in sorted(scored, key=lambda s: (-s[0], s[1], s[2])):
        if a in gone and b in come:
            gone.discard(a)
            come.discard(b)
            out.append(("renamed", a, b))
    out += [("removed", p, "") for p in gone] + [("added", p, "") for p in come] + [("type_changed", p, "") for p in changed]
    return sorted(out)


def changes(records: DataFrame) -> DataFrame:
    """The differences between each file and the one before it in its feed.

    Files are paired by an equi-join on (feed, file_seq); a pair's two unions (bounded by paths x SKETCH) are compared
    in one task. A file without a predecessor gives no row, nor does a record without a file number. Duplicate
    deliveries change counts only, never presence.
    """
    union = profile(records.where(F.col("file_seq").isNotNull()))
    both = union.select("feed", F.explode(F.array("file_seq", F.col("file_seq") + 1)).alias("of"), "file_seq", "path", "types", "sketch")

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        of = int(frame["of"].iloc[0])
        sides: dict[int, dict] = defaultdict(dict)
        for seq, path, types, sketch in zip(frame["file_seq"], frame["path"], frame["types"], frame["sketch"]):
            sides[int(seq)][path] = {"types": {t for t, n in zip(TYPES, types) if n}, "sketch": sketch}
        if of not in sides or of - 1 not in sides:
            return pd.DataFrame(columns=[f.name for f in CHANGES])
        found = compare(sides[of - 1], sides[of])
        return pd.DataFrame([(frame["feed"].iloc[0], of, *c) for c in found], columns=[f.name for f in CHANGES])

    return both.groupBy("feed", "of").applyInPandas(one, CHANGES)


def found(records: DataFrame) -> DataFrame:
    """The changes of every file of every feed."""
    return changes(records)


def fused_schema(records: DataFrame) -> DataFrame:
    """One layout for all files of a register: every path with all its alternatives, first and last file, and branches.

    A register is the part of the feed's name before the first hyphen. `canonical` is the type of the common column:
    the only alternative, else string; `branches` names the typed columns a conflicting path is split into.
    """
    names = F.array(*[F.lit(t) for t in TYPES])
    counts = profile(records).select("feed", "file_seq", "path", F.explode(F.arrays_zip(names.alias("type"), F.col("types").alias("n"))).alias("e")).select("feed", "file_seq", "path", "e.type", "e.n")
    flat = counts.where((F.col("n") > 0) & (F.col("type") != "null"))
    per = flat.groupBy(F.substring_index("feed", "-", 1).alias("register"), "path", "type").agg(
        F.sum("n").alias("n"), F.min("file_seq").alias("first_seq"), F.max("file_seq").alias("last_seq"), F.countDistinct("feed", "file_seq").alias("n_files")
    )
    alternatives = F.sort_array(F.collect_list("type"))
    return per.groupBy("register", "path").agg(
        alternatives.alias("alternatives"),
        F.when(F.count("*") == 1, F.max("type")).otherwise(F.lit("string")).alias("canonical"),
        F.when(F.count("*") > 1, F.transform(alternatives, lambda t: F.concat(F.lit("as_"), t))).otherwise(F.array().cast("array<string>")).alias("branches"),
        F.sum("n").alias("n_values"),
        F.min("first_seq").alias("first_seq"),
        F.max("last_seq").alias("last_seq"),
    )


def canonical_text(column) -> F.Column:
    """A branch's value as the canonical column holds it: scalars as text, arrays of scalars joined by '; '."""
    listed = F.from_json(column, "array<string>")
    return F.when(column.startswith("["), F.array_join(listed, "; ")).otherwise(column)


UNIFIED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("feed", T.StringType()),
        T.StructField("file_seq", T.IntegerType()),
        T.StructField("original_path", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("ordinals", T.ArrayType(T.IntegerType())),
        T.StructField("type", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

#: The last file of a name that is still in use.
OPEN = 2**31 - 1


def _first_name(path: str, live: dict[str, tuple[str, int]]) -> str:
    """The first name of a path, by its own renaming or its nearest renamed ancestor's."""
    at = path
    while at:
        if at in live:
            return live[at][0] + path[len(at) :]
        at = at[:-2] if at.endswith("[]") else at.rpartition(".")[0]
    return path


def canonical_paths(change_rows: DataFrame) -> DataFrame:
    """(feed, original_path, path, from_seq, to_seq): the first name of every path that was renamed, from the file of the renaming on.

    A feed's renamings (bounded by its files and paths) are followed in one task, in order of the files. A renamed or
    removed path takes the renamed paths below it along, so what is below a path goes by the longest one listed.
    """
    out = T.StructType([f for f in UNIFIED if f.name in ("feed", "original_path", "path")] + [T.StructField("from_seq", T.IntegerType()), T.StructField("to_seq", T.IntegerType())])

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        feed, rows, live = frame["feed"].iloc[0], [], {}
        for seq, kind, a, b in frame.sort_values(["file_seq", "change", "field"])[["file_seq", "change", "field", "new_field"]].itertuples(index=False):
            if kind not in ("renamed", "removed"):
                continue
            first = _first_name(a, live)
            below = {p: live.pop(p) for p in list(live) if p == a or p.startswith((f"{a}.", f"{a}[]"))}
            rows += [(feed, p, name, since, int(seq) - 1) for p, (name, since) in below.items() if since < seq]
            if kind == "renamed":
                live |= {b + p[len(a) :]: (name, int(seq)) for p, (name, _) in below.items()} | {b: (first, int(seq))}
        rows += [(feed, p, name, since, OPEN) for p, (name, since) in live.items()]
        return pd.DataFrame(rows, columns=[f.name for f in out])

    return change_rows.groupBy("feed").applyInPandas(one, out)


def paths_of(root: dict, names: dict[str, str]) -> Iterator[tuple[str, str, list[int], str, str]]:
    """(original path, path, ordinals, type, value) of every value below a parsed record that is not null.

    Paths are written as in `walk`, with one `[]` for an array, however deep; ordinals has the places in the arrays.
    Objects, and arrays that hold objects, have a row as they were written and are entered as well.
    """
    stack = [(root, "", "", [])]
    while stack:
        here, at, first, places = stack.pop()
        for key, child in here.items():
            p = f"{at}.{key}" if at else key
            c = names.get(p) or (f"{first}.{key}" if first else key)
            inner = [(child, p, c, places)]
            while inner:
                x, original, path, ordinals = inner.pop()
                if x is None:
                    continue
                if x is child or not isinstance(x, (dict, list)) or x == {}:
                    yield original, path, ordinals, json_type(x), x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)
                if isinstance(x, dict):
                    stack.append((x, original, path, ordinals))
                elif isinstance(x, list) and (x is not child or _holds_objects(x)):
                    inner.extend((y, f"{p}[]", f"{c}[]", [*ordinals, i]) for i, y in enumerate(x))


def _holds_objects(items: list) -> bool:
    stack = list(items)
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            return True
        if isinstance(x, list):
            stack.extend(x)
    return False


def unify(records: DataFrame, change_rows: DataFrame | None = None) -> DataFrame:
    """All records in one consistent long table: renamed paths under their first name, every value with its type tag,
    its canonical text, and its typed branch (as_string, as_number, as_boolean, as_array, as_object: one of them is set).
    One row for each path of each record, at any depth, with the ordinals of the array elements it lies in; null values
    have none. The renamings of a path and of its ancestors apply; the row of an object or of an array with objects
    holds it as it was written, the rows of what is in it have the first names.
    """
    names = canonical_paths(change_rows if change_rows is not None else changes(records))
    base = records.select(F.col("id").cast("long").alias("id"), "feed", F.col("file_seq").cast("int").alias("file_seq"), "json_data")
    # the names that hold in a file, so that a record is joined once and not each of its values
    files = base.select(F.col("feed").alias("f_feed"), F.col("file_seq").alias("f_seq")).distinct()
    of_file = files.join(names, (F.col("f_feed") == F.col("feed")) & F.col("f_seq").between(F.col("from_seq"), F.col("to_seq")))
    of_file = of_file.groupBy("f_feed", "f_seq").agg(F.collect_list(F.array("original_path", "path")).alias("names"))
    joined = base.join(of_file, (F.col("feed") == F.col("f_feed")) & (F.col("file_seq") == F.col("f_seq")), "left")

    def rows(source):
        for record, feed, seq, text, pairs in source:
            root = parse_json(text)
            if isinstance(root, dict):
                for row in paths_of(root, dict(pairs or ())):
                    yield record, feed, seq, *row

    flat = map_rows(joined.select("id", "feed", "file_seq", "json_data", "names"), UNIFIED, rows)
    value = F.col("value")
    branch = lambda t, x: F.when(F.col("type") == t, x).alias(f"as_{t}")
    return flat.select(
        "id", "feed", "file_seq", "original_path", "path", "ordinals", "type", F.when(F.col("type") == "array", canonical_text(value)).otherwise(value).alias("value"),
        branch("string", value), branch("number", value.try_cast("double")), branch("boolean", value.try_cast("boolean")), branch("array", F.from_json(value, "array<string>")), branch("object", value),
    )
