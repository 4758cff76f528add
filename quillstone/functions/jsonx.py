"""Dynamic JSON: flattening, packing into units of text, and mending of damaged model replies."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows
from quillstone.functions.text import TARGET_TOKENS, is_identifier, strip

# Keys in which registers keep their registration number, in the order of trust.
REGISTRATION_KEYS = (
    "registration_number", "ema_product_number", "numeroRegistro", "artg_id", "acceptance_no",
    "application_no", "application_number", "reg_number", "license_number", "pl_number",
)


def registration_number(json_text: Column) -> Column:
    """The first candidate that may be an identifier: the detail's number, then the keys in order; else null.

    JSON false, 0, null and empty values are no candidates. Broken JSON gives null.
    """
    at = lambda path: F.get_json_object(json_text, path)
    candidates = [at("$.detail.registration_number"), *(at(f"$.{k}") for k in REGISTRATION_KEYS)]
    ok = [F.when(is_identifier(c) & ~strip(c).isin("", "0", "false", "[]", "{}"), strip(c)) for c in candidates]
    return F.coalesce(*ok)


LEAVES = T.StructType([T.StructField("id", T.StringType()), T.StructField("path", T.StringType()), T.StructField("is_list", T.BooleanType()), T.StructField("value", T.StringType())])


def flatten(value, prefix: str = ""):
    """(dotted path, leaf) of nested objects, in document order; lists are leaves, empty and null leaves are left out."""
    stack = [(prefix, value)]
    while stack:
        path, here = stack.pop()
        if isinstance(here, dict):
            stack.extend((f"{path}.{k}" if path else k, v) for k, v in reversed(here.items()))
        elif here is not None and here != "" and here != []:
            yield path, here


def leaves(df: DataFrame, id_column: str, json_column: str) -> DataFrame:
    """(id, path, is_list, value) of every leaf of a JSON column; lists as JSON text. Null and broken JSON have none."""

    def rows(source):
        for key, text in source:
            try:
                root = json.loads(text) if text else None
            except (ValueError, RecursionError):
                continue
            if isinstance(root, dict):
                for path, v in flatten(root):
                    yield key, path, isinstance(v, list), v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)

    return map_rows(df.select(F.col(id_column).cast("string"), json_column), LEAVES, rows)


# The headings of the units of text that a record becomes.
LIST_HEADING = "Raw structured registry metadata — {path} (items {first}-{last} of {n}):"
SUMMARY_HEADING, WHOLE_HEADING = "Raw structured registry metadata (application/product summary):", "Raw structured registry metadata:"


def pack_list(path: str, items: list, target: int = TARGET_TOKENS) -> list[str]:
    """A list's items in order, in units of about target tokens, each headed by path and range of items."""
    units, held, size, first = [], [], 0, 1
    shown = [json.dumps(x, ensure_ascii=False) for x in items]
    for no, text in enumerate([*shown, None], 1):
        n = max(1, len(text) // 4) if text is not None else target + 1
        if held and size + n > target:
            units.append(f"{LIST_HEADING.format(path=path, first=first, last=no - 1, n=len(items))}\n[{', '.join(held)}]")
            held, size, first = [], 0, no
        if text is not None:
            held.append(text)
            size += n
    return units


def units_of(root, target: int = TARGET_TOKENS) -> list[str]:
    """A record as units of text: its scalars as a summary first, then its lists; the whole record if all of it is empty."""
    if not root:
        return []
    scalars, units = {}, []
    for path, v in flatten(root) if isinstance(root, dict) else ():
        if isinstance(v, list):
            units += pack_list(path, v, target)
        else:
            scalars[path] = v
    dump = lambda x: json.dumps(x, ensure_ascii=False, indent=2)
    if scalars:
        units.insert(0, f"{SUMMARY_HEADING}\n{dump(scalars)}")
    return units or [f"{WHOLE_HEADING}\n{dump(root)}"]


UNITS = T.StructType([T.StructField("id", T.StringType()), T.StructField("seq", T.IntegerType()), T.StructField("unit", T.StringType())])


def json_units(df: DataFrame, id_column: str, json_column: str, target: int = TARGET_TOKENS) -> DataFrame:
    """(id, seq, unit): the units of each record's JSON, numbered from 0."""

    def rows(source):
        for key, text in source:
            try:
                root = json.loads(text) if text else None
            except (ValueError, RecursionError):
                root = None
            for i, unit in enumerate(units_of(root, target)):
                yield key, i, unit

    return map_rows(df.select(F.col(id_column).cast("string"), json_column), UNITS, rows)


# A string (left as it is), a comma before a closing bracket, and the names of what is no finite number.
_LOOSE = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"?|(?<=[\]}"\w])[ \t\n\r]*,(?=[ \t\n\r]*[\]}])|-?\b(?:nan|inf(?:inity)?)\b', re.I | re.S)


def _strict(found: re.Match) -> str:
    t = found[0]
    return t if t[0] == '"' else "" if t[-1] == "," else "NaN" if t[-1] in "nN" else "-Infinity" if t[0] == "-" else "Infinity"


def _whole(digits: str) -> int | float:
    return int(digits) if len(digits) < 4_000 else float(digits)  # int() refuses more


def standard(text: str | None) -> str | None:
    """A record's JSON such as every parser reads alike, or None for what SQL's json_valid does not take.

    As there, a comma may stand before a closing bracket and nan and inf are numbers in any case; nothing may follow the
    value, and half a surrogate pair is no text. Of equal keys the first counts; what is no object is an empty one.
    """
    again = False

    def first(pairs: list) -> dict:
        nonlocal again
        out = dict(pairs)
        if len(out) < len(pairs):
            again = True
            out = dict(reversed(pairs))
        return out

    def read(t: str):
        return json.loads(t, object_pairs_hook=first, parse_int=_whole)

    if not text:
        return None
    try:
        try:
            root = read(text)
        except ValueError:
            text = _LOOSE.sub(_strict, text)
            root = read(text)
        if "\\u" in text:
            json.dumps(json.loads(text, object_pairs_hook=list, parse_int=_whole), ensure_ascii=False).encode()
    except (ValueError, RecursionError):
        return None
    return "{}" if not isinstance(root, dict) else json.dumps(root, ensure_ascii=False) if again else text


def standard_records(df: DataFrame, key: str, json_column: str) -> DataFrame:
    """(key, json_column) of the rows with valid JSON, as standard gives it; null, empty and broken ones are left out."""

    def rows(source):
        for k, text in source:
            if (t := standard(text)) is not None:
                yield k, t

    return map_rows(df.select(key, json_column), T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField(json_column, T.StringType())]), rows)


def sanitize(reply: Column) -> Column:
    """A model's reply without control characters, code fences and the prose around its object."""
    t = strip(F.regexp_replace(strip(F.coalesce(reply, F.lit(""))), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", ""))
    t = strip(F.regexp_replace(F.regexp_replace(t, r"(?i)^```(?:json)?\s*", ""), r"\s*```$", ""))
    inner = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    return F.when(inner != "", inner).otherwise(t)


_COMMA = re.compile(r",\s*(?=[\]}])")


def mend(text: str | None) -> str | None:
    """Damaged JSON mended, or None: raw line ends within strings escaped, stray commas dropped, what is open closed.

    Open brackets and braces are closed in the reverse order of their opening, so interleaved nesting survives truncation.
    """
    if not text or not text.strip():
        return None
    out, closers, inside, escaped = [], [], False, False
    for ch in text.strip():
        if inside:
            out.append("\\n" if ch == "\n" else ch)
            if ch == '"' and not escaped:
                inside = False
            escaped = ch == "\\" and not escaped
            continue
        if ch == '"':
            inside, escaped = True, False
        elif ch in "[{":
            closers.append("]" if ch == "[" else "}")
        elif ch in "]}" and closers and closers[-1] == ch:
            closers.pop()
        out.append(ch)
    whole = "".join(out)
    if inside:
        whole += '"'
    whole = re.sub(r",\s*$", "", whole.rstrip())
    whole = re.sub(r":\s*$", ": null", whole)
    for attempt in (whole + "".join(reversed(closers)), re.sub(r',?\s*"[^"]*"$', "", whole) + "".join(reversed(closers))):
        fixed = _COMMA.sub("", attempt)
        try:
            json.loads(fixed)
            return fixed
        except (ValueError, RecursionError):
            continue
    return None


@F.pandas_udf(T.StringType())
def _mend_udf(texts: pd.Series) -> pd.Series:
    return texts.map(mend)


def valid_json(text: Column) -> Column:
    return F.when(F.try_parse_json(text).isNotNull(), text)


def parse_reply(reply: Column) -> Column:
    """A model's reply as valid JSON text: as it is, else sanitized, else mended; null when all fail."""
    clean = sanitize(reply)
    return F.coalesce(valid_json(reply), valid_json(clean), valid_json(_mend_udf(clean)))
