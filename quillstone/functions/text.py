"""Text operators as column expressions: sizes, normalising, splitting, packing, sections and small parsers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Target size of a chunk in tokens and share of it that is repeated in front of the next one.
TARGET_TOKENS, OVERLAP = 1_800, 0.15
#: Characters that stand for one token where no tokenizer is used.
CHARS_PER_TOKEN = 4


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """text without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def count_tokens(text: Column) -> Column:
    """Size in tokens: characters div 4, at least 1; null for null."""
    return F.greatest(F.lit(1), (F.length(text) / F.lit(CHARS_PER_TOKEN)).cast("int"))


def normalize(text: Column) -> Column:
    """One kind of line end, single blanks, no more than one empty line, no outer white space; null as empty."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n|\r", "\n")
    return strip(F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def paragraphs(text: Column) -> Column:
    """Stripped, non-empty paragraphs; a text without any is itself the only one, an empty text has none."""
    parts = F.filter(F.transform(F.split(text, r"\n\s*\n"), strip), lambda p: p != "")
    return let(parts, lambda ps: F.when(F.size(ps) > 0, ps).when(text != "", F.array(text)).otherwise(F.array().cast("array<string>")))


def sentences(text: Column) -> Column:
    """Parts of a text cut behind a full stop, exclamation or question mark."""
    return F.split(text, r"(?<=[.!?])\s+")


def greedy_pack(units: Column, target: int, joiner: str, size=count_tokens) -> Column:
    """Units packed in order into groups of at most target, a larger unit alone; each group joined by joiner.

    A fold with a small accumulator, so a text of any length is packed within its row, in whole-stage code.
    """
    zero = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("open"), F.lit(0).alias("n"))

    def step(acc: Column, unit: Column) -> Column:
        n = size(unit)
        full = (F.size(acc["open"]) > 0) & (acc["n"] + n > target)
        return F.struct(
            F.when(full, F.concat(acc["done"], F.array(F.array_join(acc["open"], joiner)))).otherwise(acc["done"]).alias("done"),
            F.when(full, F.array(unit)).otherwise(F.concat(acc["open"], F.array(unit))).alias("open"),
            F.when(full, n).otherwise(acc["n"] + n).alias("n"),
        )

    end = lambda acc: F.when(F.size(acc["open"]) > 0, F.concat(acc["done"], F.array(F.array_join(acc["open"], joiner)))).otherwise(acc["done"])
    return F.aggregate(units, zero, step, end)


def chunk_units(text: Column, target: int = TARGET_TOKENS) -> Column:
    """Paragraphs of a normalised text, those above target as packs of their sentences."""
    return F.flatten(F.transform(paragraphs(text), lambda p: F.when(count_tokens(p) > target, greedy_pack(sentences(p), target, " ")).otherwise(F.array(p))))


def plain_chunks(text: Column, target: int = TARGET_TOKENS) -> Column:
    """Chunks without overlap: none for an empty text, one for a text that fits."""
    none = F.array().cast("array<string>")
    return let(normalize(text), lambda t: F.when(t == "", none).when(count_tokens(t) <= target, F.array(t)).otherwise(greedy_pack(chunk_units(t, target), target, "\n\n")))


def chunks(text: Column, target: int = TARGET_TOKENS, overlap: float = OVERLAP) -> Column:
    """Chunks of about target tokens, each after the first led by the tail of the one before it.

    The tail is taken from the chunk without its own overlap and comes on top of the target.
    """
    if overlap <= 0:
        return plain_chunks(text, target)

    def lead(plain: Column, chunk: Column, i: Column) -> Column:
        before = F.try_element_at(plain, i)
        n = F.greatest(F.lit(1), F.floor(count_tokens(before) * F.lit(overlap))).cast("int") * CHARS_PER_TOKEN
        tail = F.when(F.length(before) > n, F.substring(before, F.length(before) - n + 1, n)).otherwise(before)
        return F.when(i == 0, chunk).otherwise(F.concat(strip(tail), F.lit("\n\n"), chunk))

    return let(plain_chunks(text, target), lambda plain: F.transform(plain, lambda chunk, i: lead(plain, chunk, i)))


# Headings that bound the labelling part of a European annex document; case tells them from references.
LABELLING, ANNEX_III, NEXT_ANNEX = r"A\.\s*LABELLING", r"ANNEX\s+III\b", r"ANNEX\s+(?:I|II|IV|V)\b"


def labelling_section(text: Column) -> Column:
    """The labelling part of a document: from its heading, else from its annex's, to the next annex; null if there is none."""

    def from_head(head: str) -> Column:
        opening = F.regexp_extract(text, head, 0)
        at = F.instr(text, opening)
        rest = F.substring(text, at + F.length(opening), F.length(text))
        follows = F.regexp_extract(rest, NEXT_ANNEX, 0)
        return F.concat(opening, F.when(follows != "", F.substring(rest, F.lit(1), F.instr(rest, follows) - 1)).otherwise(rest))

    found = F.when(text.rlike(LABELLING), from_head(LABELLING)).when(text.rlike(ANNEX_III), from_head(ANNEX_III))
    return F.nullif(strip(found), F.lit(""))


def section_or_full(text: Column, country: Column) -> Column:
    """What is chunked: the labelling part for documents of the European Union that have one, else the whole text."""
    return F.coalesce(F.when(country == "European Union", labelling_section(text)), text)


def is_identifier(value: Column) -> Column:
    """Whether a value may be a registration number: it holds a digit of any script. Prose does not."""
    return F.coalesce(value.rlike(r"\p{Nd}"), F.lit(False))


def needs_ocr(doc_type: Column, pages_needing_ocr: Column, text: Column, pages: Column) -> Column:
    """Whether a document's text layer is too thin to be used."""
    n = F.length(F.coalesce(text, F.lit("")))
    return (F.coalesce(pages_needing_ocr, F.lit(0)) > 0) | (F.coalesce(doc_type, F.lit("")) != "text_based") | (n < 50) | (n / F.greatest(F.lit(1), F.coalesce(pages, F.lit(0))) < 50)


def batches(items: Column, size: int) -> Column:
    """An array cut into arrays of at most size items."""
    last = ((F.size(items) - 1) / F.lit(size)).cast("int")
    return F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * size + 1, F.lit(size)))).otherwise(F.array().cast("array<array<string>>"))


def split_oversized(text: Column, header: Column, target: int) -> Column:
    """A unit above target tokens cut into spans of target tokens, every span after the first led by the header."""
    span = target * CHARS_PER_TOKEN
    n = F.ceil(F.length(text) / F.lit(span)).cast("int")
    part = lambda i: F.substring(text, i * span + 1, F.lit(span))
    parts = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i == 0, part(i)).otherwise(F.concat(header, F.lit("\n"), part(i))))
    return F.when(count_tokens(text) > target, parts).otherwise(F.array(text))


# The reply budget of a model call.
REPLY_CAP, REPLY_FLOOR, MARGIN_TOKENS, MARGIN_SHARE, FRAME_TOKENS = 3_072, 512, 300, 0.06, 16


def reply_budget(system: Column, user: Column, window: Column) -> Column:
    """Tokens left for a reply in a model's window; null when too few remain."""
    prompt = count_tokens(system) + count_tokens(user) + FRAME_TOKENS
    left = window - prompt - F.greatest(F.lit(MARGIN_TOKENS), (prompt * MARGIN_SHARE).cast("int"))
    return F.when(left >= REPLY_FLOOR, F.least(F.lit(REPLY_CAP), left))


def duration(seconds: Column) -> Column:
    """Seconds as `1h02m`, `3m07s` or `42s`; null or negative as `?`."""
    s = seconds.cast("long")
    h, m = (s / 3600).cast("long"), ((s % 3600) / 60).cast("long")
    return F.when(s.isNull() | (s < 0), F.lit("?")).when(h > 0, F.format_string("%dh%02dm", h, m)).when(m > 0, F.format_string("%dm%02ds", m, s % 60)).otherwise(F.format_string("%ds", s))


def distinct_ci(items: Column) -> Column:
    """First occurrence of each non-blank item, compared without case and outer blanks, in order."""
    trimmed = F.filter(F.transform(items, strip), lambda x: x.isNotNull() & (x != ""))
    zero = F.struct(F.array().cast("array<string>").alias("out"), F.array().cast("array<string>").alias("seen"))

    def step(acc: Column, x: Column) -> Column:
        new = ~F.array_contains(acc["seen"], F.lower(x))
        return F.struct(F.when(new, F.array_append(acc["out"], x)).otherwise(acc["out"]).alias("out"), F.when(new, F.array_append(acc["seen"], F.lower(x))).otherwise(acc["seen"]).alias("seen"))

    return F.aggregate(trimmed, zero, step, lambda acc: acc["out"])


def split_top_level(text: Column, separator: str = ";") -> Column:
    """Parts between separators that stand outside brackets; stripped, empty ones dropped. Unmatched brackets are borne."""
    zero = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("open"), F.lit(0).alias("depth"))

    def step(acc: Column, ch: Column) -> Column:
        depth = F.when(ch == "(", acc["depth"] + 1).when(ch == ")", F.greatest(acc["depth"] - 1, F.lit(0))).otherwise(acc["depth"])
        cut_here = (ch == separator) & (depth == 0)
        return F.struct(
            F.when(cut_here, F.array_append(acc["out"], acc["open"])).otherwise(acc["out"]).alias("out"),
            F.when(cut_here, F.lit("")).otherwise(F.concat(acc["open"], ch)).alias("open"),
            depth.alias("depth"),
        )

    parts = F.aggregate(F.split(F.coalesce(text, F.lit("")), ""), zero, step, lambda acc: F.array_append(acc["out"], acc["open"]))
    return F.filter(F.transform(parts, strip), lambda p: p != "")
