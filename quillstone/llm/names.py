"""Variant spellings of names typed by people (problem 1).

Distinct names are taken apart into distinctive words, line of business, legal form and, for persons, given name;
names with equal parts form a class. Classes become candidates by MinHash banding over padded q-grams (bands and rows
read off the collision curve), candidates are verified by Monge-Elkan similarity, and star clustering links them.
"""

from __future__ import annotations

import functools
import re
import unicodedata
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows
from quillstone.llm.graph import pairs_within, star_clusters
from quillstone.llm.similarity import MinHasher, edit_distance, padded_qgrams, token_similarity, tune_bands
from quillstone.session import cut

Q = 3
#: Two names one typing slip apart have a q-gram similarity of about this or more; so many of such pairs must meet.
SLIP_SIMILARITY, RECALL = 0.5, 0.99
#: Share of the information in the distinctive words (each weighed by how rare it is) that must have a counterpart.
SAME = 0.75
#: Cores of at most so many letters also meet by keys with one letter left out: their q-grams are too few for the curve.
SHORT = 12

# Lines of business with the ways in which they are shortened.
BUSINESS = {
    "laboratories": "laboratories laboratory labs lab labors labor laboratoires laboratoire laboratorios laboratorio laboratori laboratorium",
    "biotechnology": "biotechnology biotechnologies biotech biotec",
    "industries": "industries industry inds ind industrial",
    "manufacturing": "manufacturing manufacturers manuf mfg manufacture",
    "therapeutics": "therapeutics therapeutic therap tx",
    "pharmaceuticals": "pharmaceuticals pharmaceutical pharma pharm pharms pharmaceutics farmaceutica farmaceutici pharmaceutiques pharmazeutika",
    "international": "international intl internat int'l",
    "lifesciences": "lifesciences lifescience lifesci",
    "healthcare": "healthcare hlthcare",
    "ophthalmics": "ophthalmics ophthalmic ophth",
    "vaccines": "vaccines vaccine vacc",
    "diagnostics": "diagnostics diagnostic diag",
    "bloodproducts": "bloodproducts",
    "consumercare": "consumercare",
    "animalhealth": "animalhealth",
}
# Legal forms with their spellings, blanks and dots removed.
LEGAL = {
    "ltd": "ltd limited", "gmbh": "gmbh", "inc": "inc incorporated", "co": "co company", "ag": "ag aktiengesellschaft",
    "llc": "llc", "sa": "sa sociedadanonima societeanonyme", "bv": "bv", "plc": "plc publiclimitedcompany", "corp": "corp corporation", "pvtltd": "pvtltd", "spa": "spa", "nv": "nv",
    "srl": "srl", "sarl": "sarl", "sas": "sas", "kg": "kg", "ab": "ab", "oy": "oy oyj", "aps": "aps", "as": "as", "kk": "kk", "lp": "lp", "llp": "llp", "se": "se", "kgaa": "kgaa",
    "ptyltd": "ptyltd proprietarylimited ptylimited proprietaryltd",
}
# Phrases written in several words, joined before the words are looked up.
PHRASES = [
    (r"\blife[ -]+sci(?:ences?)?\b", "lifesciences"), (r"\b(?:health|hlth)[ -]+care\b", "healthcare"), (r"\bblood[ -]+products?\b", "bloodproducts"),
    (r"\bconsumer[ -]+care\b", "consumercare"), (r"\banimal[ -]+health\b", "animalhealth"), (r"\bpublic limited company\b", "plc"),
    (r"\bsociedad anonima\b", "sa"), (r"\b(?:pty|proprietary) (?:ltd|limited)\b", "ptyltd"), (r"\bl l c\b", "llc"), (r"\bp l c\b", "plc"),
    (r"\bg m b h\b", "gmbh"), (r"\bgmbh (?:co|company)(?: kgaa| kg)?\b", "gmbh"), (r"\b(?:pvt|private) (?:ltd|limited)\b", "pvtltd"), (r"\bs p a\b", "spa"), (r"\bs r l\b", "srl"),
    (r"\bs a r l\b", "sarl"), (r"\bs a s\b", "sas"), (r"\bs a\b(?! [a-z]\b)", "sa"), (r"\bb v\b", "bv"), (r"\bn v\b", "nv"), (r"\ba g\b", "ag"), (r"\bk k\b", "kk"),
    (r"\b(abd[ue]l|abd[ue]r) (?=[a-z])", r"\1"),
]
# Words around a name that are no part of it.
TITLES = set("dr prof mr mrs ms mph rph pharmd phd md mah holder m/s messrs the".split())
LINKS = set("and of & + et und y".split())
# Given names with their usual short forms.
GIVEN = {
    "abdulrahman": "abdurrahman", "alexander": "alex sandy sasha", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben", "catherine": "cathy cate",
    "charles": "charlie chuck", "christopher": "chris kit", "daniel": "dan danny", "david": "dave", "edward": "ed eddie ned", "elizabeth": "liz beth eliza betty lisa",
    "francisco": "paco fco pancho", "frederick": "fred freddy", "friedrich": "fritz", "george": "georgie", "guillermo": "guille memo", "henry": "harry hank",
    "james": "jim jimmy", "johannes": "hans joh johann", "john": "jack johnny", "joseph": "joe", "josephine": "josie jo", "jose": "pepe",
    "katherine": "kate kathy katie", "lawrence": "larry", "margaret": "peggy maggie meg", "matthew": "matt", "michael": "mike mick", "mohammed": "muhammad mohamed mohd",
    "nicholas": "nick", "nikolaus": "nik klaus", "patricia": "pat patty", "peter": "pete", "philip": "phil", "richard": "dick rick", "robert": "rob bob bobby",
    "samuel": "sam", "stephen": "steve", "susannah": "sue susie susan", "theodore": "theo ted", "thomas": "tom tommy", "victoria": "vicky", "william": "bill will wm billy",
}

_BUSINESS = {v: k for k, words in BUSINESS.items() for v in words.split()}
_LEGAL = {v: k for k, words in LEGAL.items() for v in words.split()}
_GIVEN = {v: k for k, words in GIVEN.items() for v in [k, *words.split()]}


@functools.lru_cache(100_000)
def line_of_business(word: str) -> str:
    """The line of business a word stands for, '' for none: a known spelling, one slip from it (two from eleven letters
    on), or six letters or more of the beginnings of one line's words only."""
    if word in _BUSINESS or len(word) < 6:
        return _BUSINESS.get(word, "")
    limit = 1 if len(word) < 11 else 2
    near = {of for known, of in _BUSINESS.items() if len(known) >= 7 and (known.startswith(word) or len(word) >= 7 and edit_distance(word, known, limit) <= limit)}
    return near.pop() if len(near) == 1 else ""


_PHRASES = [(re.compile(p), r) for p, r in PHRASES]

PARTS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("core", T.StringType()),
        T.StructField("business", T.StringType()),
        T.StructField("legal", T.StringType()),
        T.StructField("given", T.StringType()),
    ]
)


def take_apart(name: str) -> tuple[str, str, str, str, str]:
    """(kind, core, business, legal, given) of a name; core words are sorted and joined by blanks.

    kind is `person` for a surname with a known given name or an initial, else `company`. A name without any
    distinctive word keeps its own letters as core, so that it matches equal ones only.
    """
    s = unicodedata.normalize("NFKD", name.lower())
    s = "".join(c for c in s if not unicodedata.combining(c))
    s = re.sub(r"\bm/s\b", " ", s)
    s = re.sub(r"[()\[\],;:/&+\"]| - |(?<=\w)-(?=\w)|(?:^|\s)-(?=\s|$)", lambda m: " " if m.group() != "-" else "-", s)
    s = re.sub(r"(?<=\w)-(?=\w)", " ", s.replace("int'l", "intl")).replace(".", " ").replace("'", "")
    s = " ".join(s.split())
    for pattern, joined in _PHRASES:
        s = pattern.sub(joined, s)
    core, business, legal, given, initials = [], [], "", "", []
    for w in s.split():
        if w in TITLES or w in LINKS or not any(c.isalnum() for c in w):
            continue
        if w in _LEGAL:
            legal = legal or _LEGAL[w]
        elif line_of_business(w):
            business.append(line_of_business(w))
        elif w in _GIVEN:
            given = given or _GIVEN[w]
        elif len(w) == 1:
            initials.append(w)
        else:
            core.append(w)
    if not business and not legal:
        if not given and core and len(core) > 1:  # a slip within the given name
            for w in list(core):
                close = [v for k, v in _GIVEN.items() if len(k) >= 5 and len(w) >= 5 and edit_distance(w, k, 1) <= 1]
                if close and len(core) > 1:
                    given = close[0]
                    core.remove(w)
                    break
        if core and (given or initials):
            return "person", " ".join(sorted(core)), "", "", given or initials[0]
    if given:
        core.append(given)
    if not core:
        core = [re.sub(r"\W+", "", name.lower()) or name]
    return "company", " ".join(sorted(core)), " ".join(sorted(set(business))), legal, ""


def distinct_names(products: DataFrame) -> DataFrame:
    """The distinct non-null, non-blank spellings of both name columns."""
    both = products.select(F.explode(F.array("mah_name", "manufacturer")).alias("name"))
    return both.where(F.col("name").isNotNull() & (F.trim("name") != "")).distinct()


def classes(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members: name, id; classes: id, kind, core, business, legal, given): names with equal parts share an id."""

    def rows(source):
        for (name,) in source:
            yield name, *take_apart(name)

    parts = map_rows(names, PARTS, rows)
    key = ["kind", "core", "business", "legal", "given"]
    members = cut(parts.withColumn("id", F.xxhash64(*key)))
    return members.select("name", "id"), members.groupBy("id", *key).agg(F.count("*").alias("n_names"))


KEYED = T.StructType([T.StructField("id", T.LongType()), T.StructField("band", T.LongType())])


def candidates(groups: DataFrame, similarity: float = SLIP_SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(a, b), a < b: classes whose core words share a band. Cores, not classes, are hashed: equal cores meet for certain.

    A bucket is joined with itself on its key, split over tasks by salt, so that one crowded bucket does not make one
    long task; copies never enter it, since they share a class.
    """
    bands, rows_per_band = tune_bands(similarity, recall)
    cores = groups.select("core").distinct()

    def rows(source):
        hasher = MinHasher(bands, rows_per_band)
        for (core,) in source:
            for key in hasher.keys(padded_qgrams(core.split(), Q)):
                yield core, key
            if 4 <= len(core) <= SHORT:
                for left_out in {core, *(core[:i] + core[i + 1 :] for i in range(len(core)) if core[i] != " ")}:
                    yield core, zlib.crc32(left_out.encode()) - (1 << 33)

    banded = map_rows(cores, T.StructType([T.StructField("core", T.StringType()), T.StructField("band", T.LongType())]), rows)
    salts = 4
    left = banded.select("band", F.col("core").alias("core_a"), F.pmod(F.xxhash64("core"), F.lit(salts)).alias("s"))
    right = banded.select("band", F.col("core").alias("core_b"), F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(salts)])).alias("s"))
    return left.join(right.hint("merge"), ["band", "s"]).where(F.col("core_a") < F.col("core_b")).select("core_a", "core_b").distinct()


def information(groups: DataFrame) -> DataFrame:
    """(core, weights): how much each word of a core tells, in the words' order: the logarithm of its rarity among all cores."""
    cores = groups.select("core").distinct()
    words = cores.select("core", F.posexplode(F.split("core", " ")).alias("at", "word"))
    counts = words.select("core", "word").distinct().groupBy("word").agg(F.count("*").alias("df"))
    told = words.join(counts.hint("merge"), "word").select("core", "at", F.log1p(F.lit(cores.count()) / F.col("df")).alias("w"))
    return told.groupBy("core").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "w"))), lambda x: x["w"]).alias("weights"))


def _likeness(a: str, b: str) -> float:
    """As token_similarity; a beginning of four letters or more stands for a word, and short words need their first letter."""
    s = token_similarity(a, b)
    if s < 1.0 and min(len(a), len(b)) < 6 and a[:1] != b[:1]:
        s = 0.0
    return s or (0.8 if min(len(a), len(b)) >= 4 and (a.startswith(b) or b.startswith(a)) else 0.0)


def core_similarity(a: list[str], b: list[str], weights_a: list[float], weights_b: list[float]) -> float:
    """Monge-Elkan similarity of two cores with weighted words, 0 when they are not the same.

    Each side's words count by their weights. With equally many words each needs a counterpart; with more on one side, the
    words left over must tell little. An abbreviation alone never ties two names.
    """
    def one(x, y, w):
        best = [max((_likeness(p, q) for q in y), default=0.0) for p in x]
        return best, sum(s * u for s, u in zip(best, w)) / sum(w)

    best_a, told_a = one(a, b, weights_a)
    best_b, told_b = one(b, a, weights_b)
    if len(a) == len(b) and not (all(best_a) and all(best_b)) or max(token_similarity(p, q) for p in a for q in b) == 0.0:
        return 0.0
    # one slip in a short word leaves 0.75 of it
    return min(told_a, told_b) if min(told_a, told_b) >= (SAME if len(a) != len(b) else 0.7) else 0.0


def similar_cores(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Verified pairs of cores with their similarity."""
    weights = information(groups)
    side = lambda x: weights.select(F.col("core").alias(f"core_{x}"), F.col("weights").alias(f"weights_{x}")).hint("merge")
    told = pairs.join(side("a"), "core_a").join(side("b"), "core_b").select("core_a", "core_b", "weights_a", "weights_b")

    def rows(source):
        for a, b, u, v in source:
            w = core_similarity(a.split(" "), b.split(" "), u, v)
            if w > 0:
                yield a, b, w

    return map_rows(told, T.StructType([T.StructField("core_a", T.StringType()), T.StructField("core_b", T.StringType()), T.StructField("w", T.DoubleType())]), rows)


def initials(groups: DataFrame) -> DataFrame:
    """(a, b, w) between a name of two plain words, which may be a person of a rare given name, and the same surname
    with only the initial of the other word."""
    plain = groups.where("kind = 'company' and business = '' and legal = ''").withColumn("words", F.split("core", " ")).where(F.size("words") == 2)
    either = F.array(*[F.struct(F.col("words")[i].alias("core"), F.substring(F.col("words")[1 - i], 1, 1).alias("given")) for i in (0, 1)])
    full = plain.select(F.col("id").alias("x"), F.explode(either).alias("e")).select("x", "e.core", "e.given")
    short = groups.where("kind = 'person' and length(given) = 1").select(F.col("id").alias("y"), "core", "given")
    return full.join(short.hint("merge"), ["core", "given"]).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.lit(0.9).alias("w"))


def links(groups: DataFrame) -> DataFrame:
    """(a, b, w) between classes that may be one company or person.

    Companies: no two different lines of business. Persons: given names agree, an initial standing for any name it
    begins. Equal legal forms and lines of business strengthen a link; a different legal form weakens it.
    """
    known = cut(similar_cores(candidates(groups), groups))
    same = groups.select(F.col("core").alias("core_a"), F.col("core").alias("core_b"), F.lit(1.0).alias("w")).distinct()
    core_pairs = known.unionByName(known.select(F.col("core_b").alias("core_a"), F.col("core_a").alias("core_b"), "w")).unionByName(same)
    side = lambda x: groups.select(*[F.col(c).alias(c if c == "kind" else f"{c}_{x}") for c in ("id", "kind", "core", "business", "legal", "given")])
    met = core_pairs.join(side("a").hint("merge"), "core_a").join(side("b").hint("merge"), ["core_b", "kind"]).where(F.col("id_a") < F.col("id_b"))
    agree = lambda c: F.when((F.col(f"{c}_a") == "") | (F.col(f"{c}_b") == ""), 0.0).when(F.col(f"{c}_a") == F.col(f"{c}_b"), 1.0).otherwise(-1.0)
    business, legal = agree("business"), agree("legal")
    initial = F.col("given_a").startswith(F.col("given_b")) & (F.length("given_b") == 1) | F.col("given_b").startswith(F.col("given_a")) & (F.length("given_a") == 1)
    given = F.when(F.col("given_a") == F.col("given_b"), 1.0).when(initial, 0.0).otherwise(-1.0)
    met = met.withColumns({"business": business, "legal": legal, "given": given})
    fits = F.when(F.col("kind") == "person", F.col("given") >= 0).otherwise((F.col("business") >= 0) & ~((F.col("business") < 1) & (F.col("legal") < 0)))
    one = met.where(fits).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), (F.col("w") + 0.1 * F.col("business") + 0.05 * F.col("legal") + 0.1 * F.col("given")).alias("w"))
    return one.unionByName(initials(groups)).groupBy("a", "b").agg(F.max("w").alias("w"))


def clusters(products: DataFrame) -> DataFrame:
    """(name, cluster, n_links): one row for each distinct spelling, with its cluster and the size of the cluster less one.

    Null and blank names have no row; a name like no other is a cluster of its own.
    """
    members, groups = classes(distinct_names(products))
    groups = cut(groups)
    # complete names become centres, so that a shortened name never ties two companies together
    grade = groups.select("id", (F.when(F.col("kind") == "person", F.when(F.length("given") > 1, 2).otherwise(0)).otherwise(F.when(F.col("business") != "", 2).otherwise(0))).alias("grade"))
    stars = star_clusters(links(groups), grade)
    of = members.join(stars.hint("merge"), "id", "left").select("name", F.coalesce("center", "id").alias("cluster"))
    size = of.groupBy("cluster").agg((F.count("*") - 1).alias("n_links"))
    return of.join(size.hint("merge"), "cluster").select("name", "cluster", "n_links")


def found(products: DataFrame) -> DataFrame:
    """All pairs of spellings of one company or person."""
    return pairs_within(clusters(products).where("n_links > 0"), "cluster", "name", "name_a", "name_b")
