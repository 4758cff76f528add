"""Matching listings to products without a key (problem 5): soft logic solved by alternating directions.

Candidates come from equi-joins on misspelling-tolerant keys. Weighted rules on similarity, exclusivity and
transitivity over the candidates make a hinge-loss Markov field, whose most probable state is a convex problem; it is
solved by consensus ADMM to a set residual, partitioned so that every rule lies within one task. A candidate's value is
its confidence.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.functions.arrowio import map_rows
from quillstone.llm.names import take_apart
from quillstone.llm.similarity import edit_distance, monge_elkan, token_similarity
from quillstone.operators.quantities import UNITS
from quillstone.session import cut

# Markets as listings write them, by code; the agencies' codes come from the geography table.
MARKETS = {
    "us": "us usa unitedstates", "gb": "gb uk unitedkingdom greatbritain", "sa": "sa ksa saudiarabia", "eu": "eu eea europeanunion", "au": "au aus australia",
    "de": "de germany", "es": "es spain", "br": "br brazil", "ca": "ca canada", "jp": "jp japan", "za": "za southafrica",
}
# Words of a dosage form, tried in this order; all words of an entry must begin one of the text's words.
FORMS = (
    ("patch", ("patch",)), ("cream", ("cream",)), ("cream", ("crm",)), ("granules", ("gran",)), ("granules", ("sachet",)), ("powder", ("powder",)), ("powder", ("pwd",)),
    ("infusion", ("inf",)), ("oral", ("oral",)), ("oral", ("syrup",)), ("injection", ("inj",)), ("capsule", ("cap",)),
    ("coated tablet", ("film", "tab")), ("coated tablet", ("fc", "tab")), ("coated tablet", ("coated", "tab")), ("tablet", ("tab",)),
)
# Words that stand in a form's text but name no medicine.
FORM_WORDS = set(
    "patch patches transdermal td cream crm granules granule gran sachet sachets powder pwd inf infusion oral syrup inj injection capsule capsules caps cap hard film coated fc tab tabs tablet tablets "
    "for in of sol soln solution and".split()
)
# Registry notes that are no licence number.
NO_LICENCE = {"na", "pending", "seepack", "oldmedicine", ""}

_MARKET = {v: k for k, words in MARKETS.items() for v in words.split()}
_STRENGTH = re.compile(r"(?<![\w.])(\d[\d,]*(?:\.\d+)?)\s*(" + "|".join(sorted((re.escape(u) for u in UNITS if u[0] not in "x%"), key=len, reverse=True)) + r"|%)(?![a-z])", re.I)

MEDICINE = [
    T.StructField("id", T.StringType()),
    T.StructField("market", T.StringType()),
    T.StructField("words", T.ArrayType(T.StringType())),
    T.StructField("strength", T.StringType()),
    T.StructField("form", T.StringType()),
    T.StructField("substances", T.StringType()),
    T.StructField("licence", T.StringType()),
    T.StructField("holder", T.StringType()),
]


def _fold(text: str) -> str:
    s = unicodedata.normalize("NFKC", text)
    return "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c)).replace("μ", "µ")


def market_code(text: str | None) -> str:
    key = re.sub(r"[^a-z]", "", (text or "").lower())
    if key in _MARKET or len(key) < 5:
        return _MARKET.get(key, key)
    near = {code for word, code in _MARKET.items() if len(word) >= 5 and edit_distance(key, word, 1) <= 1}
    return near.pop() if len(near) == 1 else key


def strengths_in(text: str) -> tuple[str, str]:
    """(signature of the strengths in common units, the text without them); volumes are no strengths."""
    found = []

    def take(m: re.Match) -> str:
        unit, factor = UNITS.get(m.group(2).lower(), ("", ""))
        if unit in ("mg", "IU", "mmol"):
            n = m.group(1)
            n = n.replace(",", "") if re.fullmatch(r"[1-9]\d{0,2}(,\d{3})+(\.\d+)?", n) else n.replace(",", ".")
            try:
                found.append(f"{float(n) * float(factor):.6g}{unit}")
            except ValueError:
                pass
        return " | "

    rest = _STRENGTH.sub(take, text)
    return " ".join(sorted(found)), rest


def form_of(text: str) -> str:
    words = re.findall(r"[a-z]+", text.replace("f.c.", "fc"))
    return next((f for f, starts in FORMS if all(any(w.startswith(s) for w in words) for s in starts)), "")


def substances_of(texts: list[str]) -> str:
    """The first words of the substances in texts (a salt follows its substance), sorted."""
    parts = [p for t in texts for p in re.split(r"[,/+&;]|\band\b|\bet\b|\by\b|\bund\b", _fold(t)) if p.strip()]
    return " ".join(sorted({re.findall(r"[a-z]+", p)[0] for p in parts if re.findall(r"[a-z]+", p)}))


def licence_key(text: str | None) -> str:
    """A licence number's letters and digits, the letter O between digits read as zero; '' for a note."""
    s = re.sub(r"^\s*(?:lic(?:ence)?|reg(?:istration)?)?\.?\s*(?:no|nr|number)?\s*[.:]?\s+(?=\S)|^\s*no:\s*", "", (text or "").strip(), flags=re.I)
    s = re.sub(r"[^a-z0-9]", "", s.lower())
    if s in NO_LICENCE or not any(c.isdigit() for c in s):
        return ""
    s = re.sub(r"o(?=\d)|(?<=\d)o", "0", s)
    return s.lstrip("0") or s


def holder_key(text: str | None) -> str:
    if not text or not text.strip():
        return ""
    kind, core, business, _, given = take_apart(text)
    return f"{kind}|{core}|{business}|{given}"


def name_words(rest: str) -> list[str]:
    """The words of a name without strength, form words and what stands in brackets."""
    plain = re.sub(r"\([^)]*\)", " ", rest)
    return [w for w in re.findall(r"[a-z]{3,}", plain.replace("f.c.", " ")) if w not in FORM_WORDS]


def read_listing(item: str | None, hint: str | None, trade: str | None, licence: str | None, holder: str | None, market: str | None) -> tuple:
    text = _fold(item or "")
    strength, rest = strengths_in(text)
    brackets = [b for b in re.findall(r"\(([^)]*)\)", rest) if form_of(b) == "" and re.search(r"[a-z]{4}", b)]
    words = name_words(rest)
    if trade:
        words = name_words(_fold(trade)) + words
    known = [hint] if hint else brackets
    return market_code(market), list(dict.fromkeys(words)), strength, form_of(rest), substances_of(known), licence_key(licence), holder_key(holder)


def read_product(name: str | None, brand: str | None, generic: str | None, ingredients: list | None, strengths: list | None, forms: list | None, licence: str | None, holder: str | None, market: str | None) -> tuple:
    strength, rest = strengths_in(_fold(name or ""))
    if not strength:
        strength, _ = strengths_in(_fold(" | ".join(x for x in strengths or [] if x)))
    form = form_of(rest) or form_of(_fold(" ".join(x for x in forms or [] if x)))
    words = name_words(rest)
    # the word by which the medicine goes: its brand, else the last word of its name (its holder's)
    chosen = name_words(_fold(brand)) if brand else words[-1:]
    known = [x for x in ingredients or [] if x] or ([generic] if generic else [])
    # the other words follow: of a medicine without a brand they are its substances
    chosen = chosen[:1] or words[-1:]
    chosen = chosen + [w for w in words if w not in chosen and not brand]
    return market, chosen, strength, form, substances_of(known), licence_key(licence), holder_key(holder)


def slips(word: str) -> list[str]:
    """A word and the word with any one letter left out: two words one slip apart share one of them."""
    return list(dict.fromkeys([word, *(word[:i] + word[i + 1 :] for i in range(len(word)))])) if len(word) > 4 else [word]


def medicines_of_listings(listings: DataFrame) -> DataFrame:
    def rows(source):
        for record, *rest in source:
            yield record, *read_listing(*rest)

    columns = [F.col("listing_id").cast("string"), "item_name", "generic_hint", "trade_name", "licence_ref", "holder", "market"]
    return map_rows(listings.select(*columns), T.StructType(MEDICINE), rows)


def medicines_of_products(products: DataFrame, geography: DataFrame) -> DataFrame:
    """Active products; the market comes from the country, else from the agency that keeps the register."""
    geo = geography.where(F.col("country_code").isNotNull())
    by_id = geo.groupBy(F.col("id").alias("country_id")).agg(F.min(F.lower(F.trim("country_code"))).alias("code_by_id"))
    by_agency = geo.where(F.col("agency_acronym").isNotNull()).groupBy(F.col("agency_acronym").alias("regulator")).agg(F.min(F.lower(F.trim("country_code"))).alias("code_by_agency"))
    active = products.where("is_active").join(by_id, "country_id", "left").join(by_agency, "regulator", "left")

    def rows(source):
        for record, *rest in source:
            yield record, *read_product(*rest)

    columns = ["id", "product_name", "brand_name", "generic_name", "active_ingredients", "strengths", "dosage_forms", "registration_number", "mah_name"]
    return map_rows(active.select(*columns, F.coalesce("code_by_agency", "code_by_id", F.lit("")).alias("market")), T.StructType(MEDICINE), rows)


def markets_agree(listing: str, product: str, same_licence: bool) -> bool:
    """Equal, or one is silent; a listing's text that is no known market is outweighed by the licence."""
    return listing == product or not listing or not product or listing not in MARKETS and same_licence


def _keys(medicines: DataFrame, of_product: bool) -> DataFrame:
    """(k, id): the join keys of a medicine: its licence; market, misspelling-tolerant word and strength, or form.

    A silent market stands for any: a side that has none, and the whole other side, have keys that name only this side.
    """

    def rows(source):
        for record, market, words, strength, form, licence in source:
            if licence:
                yield hash_key("l", licence), record
            own, other = ("product", "listing") if of_product else ("listing", "product")
            # (the silent side, the market)
            scopes = [(other, ""), ("", market) if market else (own, "")]
            for w in words[:1] if of_product else words:
                for v in slips(w):
                    for scope in scopes:
                        if strength:
                            yield hash_key("s", *scope, v, strength), record
                        if form:
                            yield hash_key("f", *scope, v, form), record

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("id", T.StringType())])
    return map_rows(medicines.select("id", "market", "words", "strength", "form", "licence"), schema, rows)


def hash_key(*parts: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest("\x1f".join(parts)) - (1 << 63)


# Weights of the soft rules; the exclusivity of a listing is a hard constraint.
W_NAME, W_LICENCE, W_SUBSTANCE, W_HOLDER, W_PRIOR, W_CONTRADICT, W_SOFT_CONTRADICT, W_TRANSITIVE = 4.0, 3.0, 2.0, 2.0, 1.0, 10.0, 5.0, 1.0
ACCEPT = 0.5
#: Alternating directions end when copies and values differ by less than this (their scaled moves by ten times it); the
#: number of steps is a guard against a field that never settles, which raises an error.
SETTLED, GUARD = 1e-4, 200_000
#: Weight of half the square of each value: with it the optimum is one point, not a face of equally good ones.
RIDGE = 0.1
#: Candidates solved at once: whole groups are taken together until they hold so many.
BATCH = 4_000
#: Rows of a join key that one task reads; a hotter key is spread over tasks.
HOT, BROADCAST_KEYS = 20_000, 100_000

FEATURES = ["name", "strength", "form", "substance", "licence", "holder"]


def likeness(a: tuple, b: tuple) -> tuple[float, ...]:
    """Similarities of a listing and a product in FEATURES' order, -1 where either side is silent."""
    _, words_a, strength_a, form_a, subst_a, lic_a, hold_a = a
    _, words_b, strength_b, form_b, subst_b, lic_b, hold_b = b
    name = max((token_similarity(x, y) for x in words_a for y in words_b[:1]), default=-1.0)
    same = lambda x, y: -1.0 if not x or not y else float(x == y)
    substance = monge_elkan(subst_a.split(), subst_b.split()) if subst_a and subst_b else -1.0
    if substance < 0 and len(words_b) > 1:
        substance = min(max(token_similarity(x, y) for x in words_a) if words_a else 0.0 for y in words_b[1:])
    elif substance >= 0 and len(subst_a.split()) != len(subst_b.split()):
        substance = min(substance, 0.5)
    licence = same(lic_a, lic_b)
    if licence == 0.0 and edit_distance(lic_a, lic_b, 1) <= 1:
        licence = -1.0  # one digit off: a slip or a neighbour, says nothing
    holder = -1.0
    if hold_a and hold_b:
        kind_a, core_a, business_a, given_a = hold_a.split("|")
        kind_b, core_b, business_b, given_b = hold_b.split("|")
        holder = monge_elkan(core_a.split(), core_b.split())
        if business_a and business_b and business_a != business_b or given_a and given_b and not (given_a.startswith(given_b) or given_b.startswith(given_a)):
            holder = min(holder, 0.2)
    return name, same(strength_a, strength_b), same(form_a, form_b), substance, licence, holder


class HingeField:
    """A hinge-loss field over candidates, as arrays; `solve` runs consensus ADMM on all of them at once.

    group numbers the independent parts of the field (none shares a listing or a tie with another). Each has its own
    step size and its own end; within a group only the ratio of weights matters, so they are divided by the greatest.
    """

    def __init__(self, listing: np.ndarray, tie: np.ndarray, weight: np.ndarray, features: np.ndarray, group: np.ndarray | None = None):
        n = self.n = len(listing)
        self.group = np.zeros(n, np.int64) if group is None else group
        greatest = np.zeros(int(self.group.max()) + 1 if n else 0)
        np.maximum.at(greatest, self.group, weight)
        weight = weight / greatest[self.group]
        f = {k: features[:, i] for i, k in enumerate(FEATURES)}
        known = {k: v >= 0 for k, v in f.items()}
        v = {k: np.where(known[k], x, 1.0) for k, x in f.items()}
        # each rule: weight, sign and offset of w * max(0, sign * x + offset)
        both = lambda *k: np.maximum(sum(v[x] for x in k) - (len(k) - 1), 0.0)
        rules = [
            (W_NAME * (known["strength"] | known["form"]), -1.0, both("name", "strength", "form")),
            (W_LICENCE * known["licence"], -1.0, both("licence", "name")),
            (W_SUBSTANCE * known["substance"], -1.0, both("substance", "name")),
            (W_HOLDER * known["holder"], -1.0, both("holder", "name")),
            (np.full(n, W_PRIOR), 1.0, np.zeros(n)),
            (W_CONTRADICT * known["strength"], 1.0, -v["strength"]),
            (W_CONTRADICT * known["form"], 1.0, -v["form"]),
            (W_CONTRADICT * known["name"], 1.0, -np.clip(2 * v["name"] - 0.75, 0, 1)),
            (W_CONTRADICT * known["substance"], 1.0, -v["substance"]),
            (W_SOFT_CONTRADICT * known["licence"], 1.0, -v["licence"]),
            (W_SOFT_CONTRADICT * known["holder"], 1.0, -v["holder"]),
        ]
        self.w = np.stack([r[0] * weight for r in rules])
        self.sign = np.array([r[1] for r in rules])[:, None]
        self.offset = np.stack([r[2] for r in rules])
        self.listing, self.tie, self.weight = listing, tie, weight

    def solve(self, settled: float = SETTLED, guard: int = GUARD) -> np.ndarray:
        """The candidates' values at the optimum, to two decimals (the residuals allow no more)."""
        out, here = np.zeros(self.n), np.arange(self.n)
        state: dict[str, np.ndarray] = {}
        for _ in range(guard):
            if not len(here):
                return np.round(out, 2)
            z, here, state = self._steps(here, state, settled, out)
        raise RuntimeError("the field did not settle")

    def _steps(self, here: np.ndarray, state: dict, settled: float, out: np.ndarray, steps: int = 50):
        """Some steps over the open groups' candidates; settled groups are written to out and leave."""
        w, sign, offset, weight = self.w[:, here], self.sign, self.offset[:, here], self.weight[here]
        listing, tie, group = (np.unique(x[here], return_inverse=True)[1] for x in (self.listing, self.tie, self.group))
        n, k = len(here), len(w)
        sizes, tied, groups = np.bincount(listing), np.bincount(tie), int(group.max()) + 1
        if not state:
            state = {"z": np.full(n, 0.5), "y": np.full(n, 0.5), "rho": np.ones(n), "u": np.zeros((k, n)), "ux": np.zeros(n), "up": np.zeros((2, n)), "uq": np.zeros((2, n))}
        z, u, ux, up, uq, rho = (state[x] for x in ("z", "u", "ux", "up", "uq", "rho"))
        y = np.zeros(len(tied))
        y[tie] = state["y"]
        for _ in range(steps):
            v = z - u
            gap = sign * v + offset
            moved = v - sign * w / rho
            x = np.where(gap <= 0, v, np.where(sign * moved + offset >= 0, moved, v - sign * gap))
            # exclusivity: the candidates of a listing sum to one at most
            e = z - ux
            over = np.maximum(np.bincount(listing, weights=e) - 1.0, 0.0) / sizes
            e = e - over[listing]
            # transitivity: like listings agree about a product, through the value y of their group
            p, q = z - up, y[tie] - uq
            for i, s in enumerate((1.0, -1.0)):
                g = s * (p[i] - q[i])
                step = np.clip(g / 2.0, 0.0, W_TRANSITIVE * weight / rho)
                p[i] -= s * step
                q[i] += s * step
            before, y_before = z, y
            z = np.clip(((x + u).sum(axis=0) + e + ux + (p + up).sum(axis=0)) / (k + 3 + RIDGE * weight / rho), 0.0, 1.0)
            y = np.clip(np.bincount(tie, weights=(q + uq).sum(axis=0)) / (2 * tied), 0.0, 1.0)
            u = u + x - z
            ux = ux + e - z
            up = up + p - z
            uq = uq + q - y[tie]
        apart = np.maximum.reduce([np.abs(x - z).max(axis=0), np.abs(e - z), np.abs(p - z).max(axis=0), np.abs(q - y[tie]).max(axis=0)])
        moves = rho / weight * np.maximum(np.abs(z - before), np.abs(y - y_before)[tie])
        most = np.zeros((2, groups))
        np.maximum.at(most[0], group, apart)
        np.maximum.at(most[1], group, moves)
        out[here] = z
        keep = ((most[0] > settled) | (most[1] > 10 * settled))[group]
        # the step size follows the slower of the two
        scale = np.where(most[0] > 10 * most[1], 2.0, np.where(most[1] > 10 * most[0], 0.5, 1.0))[group]
        scale = np.clip(rho * scale, 1e-3, 1e3) / rho
        state = {"z": z, "y": y[tie], "rho": rho * scale, "u": u / scale, "ux": ux / scale, "up": up / scale, "uq": uq / scale}
        return z, here[keep], {x: a[..., keep] for x, a in state.items()}


CANDIDATES = T.StructType(
    [T.StructField("evidence", T.LongType()), T.StructField("product_id", T.StringType()), T.StructField("weight", T.LongType()), T.StructField("tie", T.LongType()), T.StructField("features", T.ArrayType(T.DoubleType()))]
)
SOLVED = T.StructType([T.StructField("pattern", T.LongType()), T.StructField("product_id", T.StringType()), T.StructField("confidence", T.DoubleType())])


def _meet(near: DataFrame, far: DataFrame, bodies: int, hot_rows: int = HOT) -> DataFrame:
    """(evidence, product_id) that share a key; a key of more than hot_rows rows is spread over tasks by a salt.

    Keys are counted only where there are so many bodies of evidence, as fewer cannot crowd a key. The hot ones are few,
    one for hot_rows rows at most; their list is broadcast up to BROADCAST_KEYS keys and joined by merging beyond.
    """
    if bodies <= hot_rows:
        return near.join(far, "k").select("evidence", "product_id").distinct()
    hot = cut(near.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows).select("k", F.ceil(F.col("n") / hot_rows).cast("int").alias("salts")))
    hot = F.broadcast(hot) if hot.count() <= BROADCAST_KEYS else hot.hint("merge")
    left = near.join(hot, "k", "left").withColumn("s", F.coalesce(F.pmod(F.xxhash64("evidence"), F.col("salts")).cast("int"), F.lit(0)))
    right = far.join(hot, "k", "left").withColumn("s", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    return left.select("k", "s", "evidence").join(right.select("k", "s", "product_id"), ["k", "s"]).select("evidence", "product_id").distinct()


def matches(listings: DataFrame, products: DataFrame, geography: DataFrame) -> DataFrame:
    """(listing_id, product_id, confidence): every candidate with its value; the accepted are those of ACCEPT or more.

    Listings that say the same are one body of evidence with a weight, so copies, however many, cost one row. Evidence
    of one market, word, strength and form is tied together. Bodies of evidence of one tie that have the same
    products at the same similarities are interchangeable in the convex problem, so they have the same values and are
    solved as one of their added weight: a tie of any number of listings has as many rows as there are different
    similarities. A tie is solved whole, in one task, and the tasks stream from tie to tie.
    """
    said = ["market", "words", "strength", "form", "substances", "licence", "holder"]
    of_listings = cut(medicines_of_listings(listings).withColumn("evidence", F.xxhash64(*said)))
    evidence = cut(of_listings.groupBy("evidence").agg(F.count("*").alias("weight"), *[F.first(c).alias(c) for c in said]))
    of_products = cut(medicines_of_products(products, geography))
    near = cut(_keys(evidence.select(F.col("evidence").cast("string").alias("id"), *said), False).select("k", F.col("id").cast("long").alias("evidence")))
    met = _meet(near, _keys(of_products, True).withColumnRenamed("id", "product_id"), evidence.count())
    right = of_products.select(F.col("id").alias("product_id"), *[F.col(c).alias(f"p_{c}") for c in said])
    tie = F.xxhash64("market", F.array_join("words", " "), "strength", "form")
    full = met.join(evidence, "evidence").join(right, "product_id").select("evidence", "product_id", "weight", tie.alias("tie"), *said, *[f"p_{c}" for c in said])

    def alike(source):
        for e, p, weight, t, *rest in source:
            f = likeness(tuple(rest[:7]), tuple(rest[7:]))
            if markets_agree(rest[0], rest[7], f[4] == 1.0) and (f[0] >= 0.6 or f[4] == 1.0):
                yield e, p, weight, t, f

    candidates = cut(map_rows(full, CANDIDATES, alike))
    # sums of hashes stand for the set of a body's candidates: added up before the shuffle, and nothing is collected
    mark = lambda seed: F.sum(F.xxhash64(F.lit(seed), "product_id", "features").cast("decimal(38,0)"))
    bodies = candidates.groupBy("evidence").agg(F.first("tie").alias("tie"), F.first("weight").alias("weight"), mark(1).alias("m1"), mark(2).alias("m2"))
    bodies = cut(bodies.select("evidence", "weight", F.xxhash64("tie", F.col("m1").cast("string"), F.col("m2").cast("string")).alias("pattern")))
    patterns = bodies.groupBy("pattern").agg(F.min("evidence").alias("evidence"), F.sum("weight").cast("double").alias("pattern_weight"))
    tied = candidates.join(patterns, "evidence").select("tie", "pattern", "product_id", "pattern_weight", "features").repartition("tie").sortWithinPartitions("tie", "pattern", "product_id")
    solved = map_rows(tied, SOLVED, _solve_ties)
    back = of_listings.select(F.col("id").cast("long").alias("listing_id"), "evidence").join(bodies.select("evidence", "pattern"), "evidence")
    return back.join(solved, "pattern").select("listing_id", "product_id", "confidence")


def _solve_ties(source):
    """Whole ties, in order, a batch at a time; ties that put the same problem are solved once a batch."""
    held: list[tuple[tuple, list]] = []
    size, now, rows = 0, None, []

    def close():
        listing: dict = {}
        product: dict = {}
        problem = tuple((listing.setdefault(c, len(listing)), product.setdefault(p, len(product)), w, *f) for c, p, w, f in rows)
        if len(listing) == 1:  # one body of evidence: its weight does not matter
            problem = tuple((a, b, 1.0, *f) for a, b, _, *f in problem)
        held.append((problem, [(c, p) for c, p, _, _ in rows]))

    def flush():
        known = {problem: None for problem, _ in held}
        arrays, spans, at, seen_listings, seen_ties = [], {}, 0, 0, 0
        for g, problem in enumerate(known):
            a = np.array(problem)
            arrays.append(np.column_stack([a[:, 0] + seen_listings, a[:, 1] + seen_ties, np.full(len(a), g), a[:, 2:]]))
            seen_listings, seen_ties = seen_listings + int(a[:, 0].max()) + 1, seen_ties + int(a[:, 1].max()) + 1
            spans[problem] = at, at + len(a)
            at += len(a)
        a = np.concatenate(arrays)
        x = HingeField(a[:, 0].astype(np.int64), a[:, 1].astype(np.int64), a[:, 3], a[:, 4:], a[:, 2].astype(np.int64)).solve()
        for problem, names in held:
            lo, hi = spans[problem]
            for (c, p), value in zip(names, x[lo:hi].tolist()):
                yield c, p, value

    for tie, pattern, product, weight, features in source:
        if tie != now and rows:
            close()
            size += len(rows)
            rows = []
            if size >= BATCH:
                yield from flush()
                held, size = [], 0
        now = tie
        rows.append((pattern, product, weight, features))
    if rows:
        close()
        yield from flush()


def linked(listings: DataFrame, products: DataFrame, geography: DataFrame) -> DataFrame:
    """(listing_id, product_id, confidence): the one accepted product of each listing that has one; ties go to the smaller id."""
    best = F.max_by("product_id", F.struct("confidence", F.reverse("product_id"))).alias("product_id")
    accepted = matches(listings, products, geography).where(F.col("confidence") >= ACCEPT)
    return accepted.groupBy("listing_id").agg(best, F.max("confidence").alias("confidence"))


def found(listings: DataFrame, products: DataFrame, geography: DataFrame) -> DataFrame:
    return linked(listings, products, geography).select("listing_id", "product_id")
