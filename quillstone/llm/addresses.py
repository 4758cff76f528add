"""Same postal address written differently (problem 6): multi-pass sorted neighbourhoods.

Distinct addresses are parsed into components; addresses with equal components form a class. The classes are sorted
once for each of several component orders, neighbours within a window are compared by edit distance with adjacent
transpositions, house number, unit and postcode having to agree exactly, and the matches are linked by star clustering.
Where more classes share a leading key than a window spans, each is compared with the best connected ones of the run
too, and the centres and lone classes of such runs are sorted and compared again until no link is new.
"""

from __future__ import annotations

import re
import unicodedata
from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows
from quillstone.llm.graph import pairs_within, star_clusters
from quillstone.llm.similarity import edit_distance
from quillstone.session import cut

#: Rows that each row is compared with, to either side, in each order; longer runs of one leading key are gone through in rounds.
WINDOW = 16
#: Positions compared in one task.
BLOCK = 4096

# Kinds of thoroughfare with their short forms.
STREETS = {
    "street": "street st str", "avenue": "avenue ave av", "road": "road rd", "lane": "lane ln la", "drive": "drive dr drv", "boulevard": "boulevard blvd boul bd",
    "square": "square sq", "businesspark": "businesspark", "industrialestate": "industrialestate", "way": "way", "court": "court ct", "place": "place plc", "highway": "highway hwy",
    "terrace": "terrace ter", "parkway": "parkway pkwy", "crescent": "crescent cres",
}
# Kinds of unit with their short forms.
UNITS = {"unit": "unit u", "building": "building bldg bld b", "floor": "floor flr fl", "plot": "plot pl", "suite": "suite ste", "block": "block blk", "room": "room rm"}
# Countries with the ways in which they are written.
COUNTRIES = {
    "us": "united states|united states of america|usa|u s a|u s|us", "gb": "united kingdom|great britain|uk|u k|gb", "de": "germany|deutschland|de|d|ger",
    "fr": "france|fr|fra", "es": "spain|espana|es|esp", "au": "australia|aus|au", "sa": "saudi arabia|kingdom of saudi arabia|ksa|k s a|sa",
    "ch": "switzerland|schweiz|suisse|ch", "it": "italy|italia|it", "ie": "ireland|ie", "in": "india|ind", "jp": "japan|jp", "ca": "canada|ca", "br": "brazil|brasil|br",
}

# Kinds of thoroughfare that stand before the name, with their short forms, and endings of German compounds.
BEFORE = {"street": "rue r calle c/ via rua ulica ul", "avenue": "avenida avda", "square": "plaza plza piazza", "boulevard": "bulevar", "lane": "camino chemin"}
ENDINGS = {"street": "strasse str", "lane": "weg gasse", "square": "platz pl", "avenue": "allee"}
# Small words within names of streets and places, which writers add and leave out.
ARTICLES = set("de la le les du des del della di da do dos das der den dem el los las of the et y".split())

_BEFORE = {v: k for k, words in BEFORE.items() for v in words.split()}
_ENDING = {v: k for k, words in ENDINGS.items() for v in words.split()}
_COMPOUND = re.compile(r"([^\W\d_]{3,}?)(" + "|".join(sorted(_ENDING, key=len, reverse=True)) + r")")
_STREET = {v: k for k, words in STREETS.items() for v in words.split()}
_UNIT = {v: k for k, words in UNITS.items() for v in words.split()}
_COUNTRY = {v: k for k, words in COUNTRIES.items() for v in words.split("|")}
_COUNTRY_RE = re.compile(r"(?<![^\s])(" + "|".join(sorted((re.escape(v) for v in _COUNTRY if " " in v), key=len, reverse=True)) + r")(?![^\s])")
_UNIT_RE = re.compile(r"(?<![^\s|])(" + "|".join(sorted(_UNIT, key=len, reverse=True)) + r") (?:no |nr |number |# ?)?(\d+[a-z]?)(?![^\s|])")
# five or six digits (also with an addition or a gap), and the letter-and-digit codes of Britain, Canada and the Netherlands
_POST_RE = re.compile(r"(?<![^\s|])(\d{5,6}(?=-\d{4}(?![^\s|]))|\d{5,6}|\d{3} \d{3}|[a-z]{1,2}\d[a-z\d]? ?\d[a-z]{2}|[a-z]\d[a-z] ?\d[a-z]\d|\d{4} ?[a-z]{2}(?<!st|nd|rd|th))(?:-\d{4})?(?![^\s|])")

PARTS = T.StructType(
    [
        T.StructField("address", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("house", T.StringType()),
        T.StructField("street", T.StringType()),
        T.StructField("road", T.StringType()),
        T.StructField("postcode", T.StringType()),
        T.StructField("place", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)
KEY = ["unit", "house", "street", "road", "postcode", "place", "country"]


def parse(address: str) -> tuple[str, str, str, str, str, str, str]:
    """(unit, house, street, road, postcode, place, country); '' for what is absent. Place words keep their order of writing.

    street is the distinctive word(s) before the kind of road; unit is kind and number; a text without any component
    keeps all its words as place.
    """
    s = unicodedata.normalize("NFKD", address.lower()).replace("ß", "ss")
    s = "".join(c for c in s if not unicodedata.combining(c))
    s = re.sub(r"(?<![^\s,;])c/\s*(?=[^\W\d])", "c/ ", s)
    s = re.sub(r"\s*[,;\n\r\t]\s*| - ", " | ", s)
    s = re.sub(r"[.'’\"()]", " ", s).replace("#", " no ")
    s = " ".join(s.split())
    s = re.sub(r"\b(?:business|bus) (?:park|pk)\b", "businesspark", s)
    s = re.sub(r"\b(?:industrial|ind) (?:estate|est)\b", "industrialestate", s)
    country, separated = "", "|" in s

    def take_country(m: re.Match) -> str:
        nonlocal country
        country = country or _COUNTRY[m.group(1)]
        return " "

    s = _COUNTRY_RE.sub(take_country, s)
    units = []

    def take_unit(m: re.Match) -> str:
        units.append(f"{_UNIT[m.group(1)]} {m.group(2)}")
        return " | "

    s = _UNIT_RE.sub(take_unit, f" {s} ".replace("  ", " "))
    postcode = ""

    def take_post(m: re.Match) -> str:
        nonlocal postcode
        if postcode:
            return m.group(0)
        postcode = m.group(1).replace(" ", "")
        return " | "

    s = _POST_RE.sub(take_post, s)
    words = s.split()
    house, street, road, place = "", [], "", []
    before = next((i for i, w in enumerate(words[:-1]) if w in _BEFORE and (i == 0 or words[i - 1] == "|" or words[i - 1][0].isdigit()) and words[i + 1][0].isalpha()), None)
    at = next((i for i, w in enumerate(words) if w in _STREET and i > 0 and words[i - 1] != "|" and not words[i - 1].isdigit()), None)
    compound = next((i for i, w in enumerate(words) if _COMPOUND.fullmatch(w)), None) if before is None and at is None else None
    if before is not None or compound is not None:
        start = before if before is not None else compound
        end = start + 1
        if before is not None:  # the name goes on to the next number or separator
            road = _BEFORE[words[before]]
            while end < len(words) and words[end] != "|" and not words[end][0].isdigit() and (separated or sum(w not in ARTICLES for w in words[start + 1 : end]) < 1):
                end += 1
            street = [w for w in words[start + 1 : end] if w not in ARTICLES]
        else:
            stem, ending = _COMPOUND.fullmatch(words[compound]).groups()
            street, road = [stem], _ENDING[ending]
        rest = words[:start] + ["|"] + words[end:]
        near = [w for w in words[start - 1 if start else 0 : start] + [w for w in words[end : end + 2] if w != "|"][:1] if w[0].isdigit()]
        if near:
            house = near[0]
            rest.remove(house)
    elif at is not None:
        road = _STREET[words[at]]
        start = at - 1
        while start > 0 and words[start - 1] not in ("|", "no", "nr") and not words[start - 1][0].isdigit() and at - start < 2:
            start -= 1
        street = words[start:at]
        # in a text without separators the street is the one word before the kind of road
        if not separated and len(street) > 1:
            street, start = street[-1:], at - 1
        rest = words[:start] + ["|"] + words[at + 1 :]
        near = [w for w in (words[start - 1 : start] + words[at + 1 : at + 2] if start else words[at + 1 : at + 2]) if w[0].isdigit()]
        if near:
            house = near[0]
            rest.remove(house)
    else:
        rest = words
    for w in rest:
        if w in ("|", "no", "nr", "number"):
            continue
        if w[0].isdigit() and not house:
            house = w
        elif not country and w in _COUNTRY:
            country = _COUNTRY[w]
        elif w not in _COUNTRY and w not in ARTICLES:
            place.append(w)
    return " ".join(sorted(units)), house, " ".join(street), road, postcode, " ".join(sorted(place)), country


def distinct_addresses(products: DataFrame) -> DataFrame:
    """The distinct non-null, non-blank writings of both address columns."""
    both = products.select(F.explode(F.array("mah_address", "manufacturer_address")).alias("address"))
    return both.where(F.col("address").isNotNull() & (F.trim("address") != "")).distinct()


def classes(addresses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: address, id; classes: id and components)."""

    def rows(source):
        for (address,) in source:
            yield address, *parse(address)

    members = cut(map_rows(addresses, PARTS, rows).withColumn("id", F.xxhash64(*KEY)))
    return members.select("address", "id"), members.groupBy("id", *KEY).agg(F.count("*").alias("n"))


def _word(a: str, b: str) -> float:
    """Likeness of two words: 1 - distance / length within one edit (two from nine letters on), else 0; numbers must be equal."""
    if a == b:
        return 1.0
    if any(c.isdigit() for c in a) or any(c.isdigit() for c in b):
        return 0.0
    longest = max(len(a), len(b))
    limit = 0 if longest < 3 else 1 if longest < 9 else 2
    d = edit_distance(a, b, limit)
    return 0.0 if d > limit else 1.0 - d / longest


def _contained(small: list[str], large: list[str]) -> float:
    """Mean likeness of the words of small with those of large; 0 when one of them has no counterpart."""
    total = 0.0
    for w in small:
        best = max((_word(w, v) for v in large), default=0.0)
        if best == 0.0:
            return 0.0
        total += best
    return total / len(small)


def score(a: tuple, b: tuple) -> float:
    """How surely two parsed addresses denote one site, 0 when they do not; both are (unit, house, street, road, postcode, place, country).

    Units and house numbers must be equal, present or absent alike; postcodes, countries and kinds of road must not
    contradict; the place words of one must all be among those of the other, up to typing slips; the street may differ
    by a slip. Where nothing says that the place is one (no common postcode, no common place word), there is no match.
    """
    unit_a, house_a, street_a, road_a, post_a, place_a, country_a = a
    unit_b, house_b, street_b, road_b, post_b, place_b, country_b = b
    if unit_a != unit_b or house_a != house_b or road_a and road_b and road_a != road_b:
        return 0.0
    if post_a and post_b and post_a != post_b or country_a and country_b and country_a != country_b:
        return 0.0
    if not street_a or not street_b:
        if street_a or street_b or not (place_a and place_a == place_b):
            return 0.0
        street = 1.0
    else:
        street = _word(street_a, street_b)
        if street == 0.0:
            return 0.0
    x, y = place_a.split(), place_b.split()
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    place = _contained(small, large) if small else 0.0
    if small and place == 0.0:
        return 0.0
    same_post = bool(post_a) and post_a == post_b
    if not same_post and not small:
        return 0.0
    return street + 0.5 * place + 0.5 * same_post + 0.1 * (bool(country_a) and country_a == country_b)


# The orders of components by which the classes are sorted.
ORDERS = (
    ("street", "house", "unit", "postcode", "place"),
    ("house", "unit", "tserts", "postcode", "place"),
    ("postcode", "house", "unit", "street", "place"),
    ("place", "house", "unit", "street", "postcode"),
)

KEYED = T.StructType([T.StructField("pass", T.IntegerType()), T.StructField("key", T.StringType()), T.StructField("id", T.LongType()), *[T.StructField(k, T.StringType()) for k in KEY]])
POSITIONED = T.StructType([*KEYED, T.StructField("part", T.IntegerType()), T.StructField("at", T.LongType())])
LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("w", T.DoubleType())])


def neighbour_links(groups: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(a, b, w): classes within a window of each other in one of the orders that denote one site.

    One range-partitioned sort serves all orders, so no task holds more than its range and ties are ordered by id.
    Rows get their global positions from the partitions' counts (one number a task on the driver); blocks of positions
    overlap by the window, so that neighbours on both sides of a border still meet.
    """

    def keyed(source):
        for record, *parts in source:
            have = dict(zip(KEY, parts)) | {"tserts": parts[2][::-1]}
            for i, order in enumerate(ORDERS):
                if have[order[0]]:
                    yield i, "\x1f".join(have[k] for k in order), record, *parts

    rows = map_rows(groups.select("id", *KEY), KEYED, keyed)
    ordered = rows.repartitionByRange("pass", "key", "id").sortWithinPartitions("pass", "key", "id")

    def numbered(source):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for at, row in enumerate(source):
            yield *row, part, at

    placed = cut(map_rows(ordered, POSITIONED, numbered))
    counts = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return groups.sparkSession.createDataFrame([], LINKS)
    offsets, total = {}, 0
    for part in sorted(counts):
        offsets[part], total = total, total + counts[part]
    start = F.create_map(*[F.lit(x) for part, n in offsets.items() for x in (part, n)])
    at = start[F.col("part")] + F.col("at")
    placed = placed.withColumn("at", at.cast("long")).drop("part")
    # a row belongs to its block and, if it is among the first of it, also to the end of the block before
    home = F.floor(F.col("at") / block)
    blocks = placed.withColumn("block", F.explode(F.when((F.col("at") % block < window) & (home > 0), F.array(home, home - 1)).otherwise(F.array(home))))

    def compare(source):
        held: deque = deque()
        here = None
        for b, pass_no, _, record, *parts in source:
            if (b, pass_no) != here:
                held.clear()
                here = (b, pass_no)
            mine = tuple(parts)
            for other, theirs in held:
                if theirs[0] == mine[0] and theirs[1] == mine[1] and other != record:
                    w = score(theirs, mine)
                    if w > 0:
                        yield min(other, record), max(other, record), w
            held.append((record, mine))
            if len(held) > window:
                held.popleft()

    tasks = max(1, min(total // block + 1, 4 * groups.sparkSession.sparkContext.defaultParallelism))
    lined = blocks.repartition(tasks, "block").sortWithinPartitions("block", "at").select("block", "pass", "key", "id", *KEY)
    return map_rows(lined, LINKS, compare).groupBy("a", "b").agg(F.max("w").alias("w"))


def _scored(met: DataFrame) -> DataFrame:
    """The links among met pairs (id_a, id_b and the components of both)."""

    def rows(source):
        for x, y, *parts in source:
            w = score(tuple(parts[: len(KEY)]), tuple(parts[len(KEY) :]))
            if w > 0:
                yield min(x, y), max(x, y), w

    return map_rows(met.select("id_a", "id_b", *[f"{k}_a" for k in KEY], *[f"{k}_b" for k in KEY]), LINKS, rows)


def leads(groups: DataFrame) -> DataFrame:
    """(lead, id): the leading keys of a class. Two classes of one site share one, but for slips in every word of it."""
    fixed = [F.col("house"), F.col("unit")]
    key = lambda mark, *c: F.xxhash64(F.lit(mark), *fixed, *c)
    by_post = F.when(F.col("postcode") != "", key("post", F.col("postcode")))
    by_place = F.when(F.col("place") != "", key("place", F.col("place")))
    by_word = F.when((F.col("street") != "") & (F.col("place") != ""), F.transform(F.split("place", " "), lambda w: key("word", F.col("street"), w)))
    keys = F.array_compact(F.concat(F.array(by_post, by_place), F.coalesce(by_word, F.array().cast("array<bigint>"))))
    return groups.select(F.explode(F.array_distinct(keys)).alias("lead"), "id")


def pivot_links(groups: DataFrame, near: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(links, ids): in every run of more than `window` classes with one leading key, each class is compared with the
    `window` best connected ones; ids are the classes of such runs.

    A run's pivots are picked by a limited window function, which leaves `window` rows a task before the shuffle; the
    rows of a hot run are spread by a salt.
    """
    of = cut(leads(groups))
    runs = of.groupBy("lead").agg(F.count("*").alias("n")).where(F.col("n") > window).select("lead")
    of = cut(of.join(runs, "lead"))
    links_of = near.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    ranked = of.join(links_of, "id", "left").join(groups.select("id", "grade", F.col("n").alias("times")), "id")
    order = Window.partitionBy("lead").orderBy(F.coalesce("degree", F.lit(0)).desc(), F.desc("grade"), F.desc("times"), "id")
    pivots = ranked.withColumn("no", F.row_number().over(order)).where(F.col("no") <= window)
    salts = 8
    right = pivots.select("lead", F.col("id").alias("id_b"), F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(salts)])).alias("s"))
    left = of.select("lead", F.col("id").alias("id_a"), F.pmod(F.xxhash64("id"), F.lit(salts)).alias("s"))
    met = left.join(right, ["lead", "s"]).where("id_a <> id_b").select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).distinct()
    side = lambda x: groups.select(F.col("id").alias(f"id_{x}"), *[F.col(k).alias(f"{k}_{x}") for k in KEY])
    return _scored(met.join(side("a"), "id_a").join(side("b"), "id_b")), of.select("id").distinct()


def _together(moved: DataFrame, groups: DataFrame) -> DataFrame:
    """(id, center): a class follows its centre to another centre unless the two contradict each other."""
    side = lambda x, name: groups.select(F.col("id").alias(name), *[F.col(k).alias(f"{k}_{x}") for k in ("postcode", "country", "road")])
    free = lambda k: (F.col(f"{k}_a") == "") | (F.col(f"{k}_b") == "") | (F.col(f"{k}_a") == F.col(f"{k}_b"))
    seen = moved.join(side("a", "id"), "id").join(side("b", "center"), "center")
    return seen.select("id", F.when(free("postcode") & free("country") & free("road"), F.col("center")).otherwise(F.col("first")).alias("center"))


def sites(groups: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, center): the star of every class that is linked to another.

    The first round sorts and compares all classes. Later rounds take the centres and lone classes of runs longer than a
    window, which move closer together as the satellites leave, and end when a round links nothing; each
    round that links takes classes out, so that the number of rounds is bounded by the length of the longest run over the window.
    """
    grade = groups.select("id", "grade")
    alive, of = groups, None
    while True:
        near = cut(neighbour_links(alive, window))
        more, crowded = pivot_links(alive, near, window)
        links = cut(near.unionByName(more).groupBy("a", "b").agg(F.max("w").alias("w")))
        if links.isEmpty():
            break
        stars = cut(star_clusters(links, grade))
        if of is None:
            of = stars
        else:
            step = stars.select(F.col("id").alias("center"), F.col("center").alias("next"))
            kept = of.join(step, "center", "left")
            still = kept.where("next is null or next = center").select("id", "center")
            moved = kept.where("next <> center").select("id", F.col("center").alias("first"), F.col("next").alias("center"))
            fresh = stars.join(of.select("id"), "id", "left_anti")
            of = cut(still.unionByName(_together(moved, groups)).unionByName(fresh))
        satellites = stars.where("id <> center").select("id")
        alive = cut(alive.join(crowded, "id", "left_semi").join(satellites, "id", "left_anti"))
        if alive.isEmpty():
            break
    return of if of is not None else groups.sparkSession.createDataFrame([], "id bigint, center bigint")


def clusters(products: DataFrame) -> DataFrame:
    """(address, cluster, n_links): one row for each distinct writing, with its cluster and the cluster's size less one.

    Null and blank addresses have no row; an address like no other is a cluster of its own.
    """
    members, groups = classes(distinct_addresses(products))
    parts = sum(F.when(F.col(k) != "", 1).otherwise(0) for k in ("postcode", "country"))
    groups = cut(groups.withColumn("grade", (parts * 10 + F.size(F.split("place", " "))).cast("int")))
    of = members.join(sites(groups), "id", "left").select("address", F.coalesce("center", "id").alias("cluster"))
    size = of.groupBy("cluster").agg((F.count("*") - 1).alias("n_links"))
    return of.join(size, "cluster").select("address", "cluster", "n_links")


def found(products: DataFrame) -> DataFrame:
    """All pairs of writings of one site."""
    return pairs_within(clusters(products).where("n_links > 0"), "cluster", "address", "address_a", "address_b")
