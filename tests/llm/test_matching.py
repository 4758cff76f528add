"""Names, addresses and listings: linked variants, kept distinctions, odd input."""

import itertools
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillstone.llm import addresses, graph, linkage, names
from quillstone.llm.similarity import MinHasher, collision, edit_distance, monge_elkan, padded_qgrams, tune_bands

NAMES = "id string, mah_name string, manufacturer string, mah_address string, manufacturer_address string, name string, cluster string"


def products(spark, first, second=None):
    second = second or [None] * len(first)
    return spark.createDataFrame([(str(i), a, b, a, b, "x", "y") for i, (a, b) in enumerate(zip(first, second))], NAMES)


def pairs(df):
    return {tuple(r) for r in df.collect()}


def within(groups):
    return {tuple(sorted(p, key=lambda s: s.encode())) for g in groups for p in itertools.combinations(sorted(set(g)), 2)}


# ---- similarity


def slow_distance(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@given(st.text("abc", max_size=9), st.text("abc", max_size=9), st.integers(0, 4))
def test_edit_distance(a, b, limit):
    assert edit_distance(a, b, limit) == min(slow_distance(a, b), limit + 1)


def test_bands_follow_the_collision_curve():
    for similarity in (0.3, 0.5, 0.8):
        bands, rows = tune_bands(similarity, 0.99)
        assert collision(similarity, bands, rows) >= 0.99 and bands * rows <= 320
    hasher, hits = MinHasher(*tune_bands(0.5, 0.99)), 0
    for i in range(200):
        a, b = f"velorigaston{i:03}x", f"velorgaston{i:03}x"
        hits += bool(set(hasher.keys(padded_qgrams([a]))) & set(hasher.keys(padded_qgrams([b]))))
    assert hits >= 196 and MinHasher(4, 2).keys(set()) == []
    assert monge_elkan(["a"], []) == 0.0 and monge_elkan(["velor", "gaston"], ["gaston", "velor"]) == 1.0


# ---- names

COMPANIES = [
    ["Dorugal & Ventomir Laboratories B.V.", "DORUGAL + VENTOMIR LABS B V", "Ventomir/Dorugal Lab.", "M/s Dorugall and Ventomir Labors. BV [holder]"],
    ["Karapelun Vaccines Ltd", "KARAPELUN VACCINES LIMITED", "Vaccines Karapelun"],
    ["Karapelun Pharmaceuticals AG", "Karapelun Pharma Aktiengesellschaft", "Karapeuln Pharm."],
    ["Zomirelat Industries Inc.", "Zomirelat", "Zomirelat Ind, Incorporated (MAH)"],
]
PERSONS = [["Katherine Orlavento", "Dr. K. Orlavento", "ORLAVENTO Kate", "Orlavento, Kathy"], ["Robert Orlavento", "Bob Orlavento, RPh", "R Orlavnto"], ["Nikolaus Beremadur", "Klaus Beremadur"]]


def test_names(spark):
    groups = COMPANIES + PERSONS
    everyone = [n for g in groups for n in g]
    found = names.found(products(spark, everyone + everyone[:3] + [None, "", " "], everyone[::-1] + [None] * 6))
    assert pairs(found) == within(groups) and found.columns == ["name_a", "name_b"]
    clusters = names.clusters(products(spark, everyone))
    assert clusters.count() == len(set(everyone)) and clusters.where("n_links < 0").count() == 0


ALIKE = [
    ("Velora Corp", "Velora Corporation"), ("Belgator Pvt Ltd", "Belgator Private Limited"), ("Zumidor S.p.A.", "ZUMIDOR SPA"), ("Rakelin NV", "Rakelin N.V."), ("Ostrafum GmbH & Co KG", "Ostrafum GmbH"),
    ("Laboratoire Pelimont", "Laboratoires Pelimont"), ("Cadrivex Biotech", "Cadrivex Biotechnology"), ("Nolubran Pharmaceuticals", "Nolubran Pharmaceuticls"), ("Dorugal Ventomir", "D. Ventomir"),
    ("Werck KGaA", "Werk KGaA"), ("Tsufer Inc", "Tsufre Inc"), ("Hagenbeck Sonderwaren", "Hagenbeck Sonderwarn"),
]
UNLIKE = ["Pelorast Biotech", "Mirabel Derm", "Mirabel Onco", "Bayer", "Mayer", "T. Ventomir", "Hagenbeck Feinkost"]


def test_names_written_shorter_or_with_slips(spark):
    """Forms and lines of business of many countries, slips in short names, an initial for a rare given name."""
    everyone = [n for p in ALIKE for n in p] + UNLIKE
    assert pairs(names.found(products(spark, everyone))) == within(ALIKE)


def test_words_that_tell_little_may_be_left_out(spark):
    """Sonderwaren stands in most names, so that it does not tell them apart; a rare word does."""
    firms = [f"{a}{b} Sonderwaren" for a in ("Hage", "Mol", "Zirk", "Pran", "Uld") for b in ("nbeck", "tavio", "umer", "adix", "osker", "ylfint")]
    assert pairs(names.found(products(spark, [*firms, "Moltavio", "Zirkosker Feinkost"]))) == within([["Moltavio", "Moltavio Sonderwaren"]])


def test_names_on_odd_input(spark):
    odd = ["...", "-", "Dr.", "Ltd", "x" * 20_000, "x" * 20_000 + "y", "é", " ", "M/s", None]
    assert names.clusters(products(spark, odd)).count() == len([n for n in odd if n and n.strip(" ")])
    assert names.found(products(spark, ["a"]).limit(0)).count() == 0
    assert names.found(products(spark, [None, None])).count() == 0


# ---- addresses

SITES = [
    ["104 Stolumirandu Industrial Estate, Holmeport, Oakshire D9 4AB, Germany", "104 Solumirandu Industrial Estate\nHolmeport", "104 Stolumirandu Ind Est; Holmeport; Germany", "D94AB Holmeprot, Stolumirandu Ind. Est. 104, DE"],
    ["105 Stolumirandu Industrial Estate, Holmeport, Oakshire D9 4AB, Germany"],
    ["Unit 4, 77 Melunasandem Avenue, Greystead, Oakshire 74957, Spain", "Melunasandem Avenue 77\nunit 4\nGreystead\n74957", "U 4 - No. 77 Melunasandem Ave - 74957 - España"],
    ["Unit 35, 77 Melunasandem Avenue, Greystead, Oakshire 74957, Spain", "74957 Greystead, Melunasandem Avenue 77, U 35, Spain"],
    ["77 Melunasandem Avenue, Greystead, Oakshire 74957, Spain"],
    ["10 Lorunaknopuk Avenue, Ferringham, Lower Ferring F50 4LX, Germany", "10 Lorunnaknopuk Ave.,Ferringham,F50 4LX,Germany"],
    ["10 Lorunaknopuk Avenue, Riovalle, Serrana N80 6HT, Germany", "N80 6HT Riovalle Lorunaknopuk Ave. 10 DE"],
]


def test_addresses(spark):
    everyone = [a for g in SITES for a in g]
    assert pairs(addresses.found(products(spark, everyone + everyone[:2] + [None, ""]))) == within(SITES)


def test_neighbours_meet_across_blocks(spark):
    roads = [f"{i} Velomasin Road, Kirkstad, {10000 + i}, France" for i in range(60)]
    again = [f"{10000 + i} Kirkstad; Velomasn Rd {i}; FR" for i in range(60)]
    _, groups = addresses.classes(addresses.distinct_addresses(products(spark, roads, again)))
    assert addresses.neighbour_links(groups, window=4, block=7).count() == 60


def slipped(word, n, seed=5):
    """n different spellings of a word, each one letter changed, added or left out, the word itself first."""
    rng, out = random.Random(seed), {word: None}
    while len(out) < n:
        i, c = rng.randrange(len(word)), rng.choice("abcdefghijklmnopqrstuvwxyz")
        out.setdefault(rng.choice([word[:i] + c + word[i + 1 :], word[:i] + c + word[i:], word[:i] + word[i + 1 :]]))
    return list(out)


@pytest.mark.parametrize("street, n", [("Stolumirandu", 71), ("Velomas", 71), ("Stolumirandu", 500)])
def test_a_site_in_more_spellings_than_a_window(spark, street, n):
    """Every spelling is one slip from the right one, and two from most others."""
    spellings = [f"104 {w} Road, Holmeport, Oakshire D9 4AB" for w in slipped(street, n)]
    rng = random.Random(3)
    spellings = [x.replace(", Oakshire", "") if rng.random() < 0.2 else x.replace(" D9 4AB", "") if rng.random() < 0.1 else x for x in spellings]
    other = [f"{i} {street} Road, Holmeport, Oakshire D9 4AB" for i in range(1, 30)]
    found = pairs(addresses.found(products(spark, spellings + other)))
    want = within([spellings])
    assert found <= want and len(found) >= 0.9 * len(want)


def test_one_street_in_many_towns(spark):
    towns = [f"{a}{b}{c}stad" for a in ("Kirk", "Vel", "Mor") for b in ("ola", "ine", "uba") for c in ("run", "gat", "pel", "dom", "fas")]
    full = [f"7 Main Street, {t}, Oakshire {20000 + i}" for i, t in enumerate(towns)]
    short = [f"7 Main St, {t}" for t in towns]
    assert pairs(addresses.found(products(spark, full, short))) == within([list(x) for x in zip(full, short)])


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("10 Downing Street, London SW1A 1AA", "10 Downing St., SW1A1AA London, UK", True), ("12 MG Road, Bengaluru 560001, India", "No. 12, MG Rd, Bengaluru 560 001", True),
        ("Hauptstraße 5, 10115 Berlin", "Hauptstr. 5, 10115 Berlin, Germany", True), ("Calle Mayor 3, 28013 Madrid", "C/ Mayor, 3, Madrid 28013, Spain", True),
        ("12 Rue de la Paix, 75002 Paris", "12 r. de la Paix, Paris 75002 France", True), ("12 Rue de la Paix, 75002 Paris", "12 Rue du Bac, 75002 Paris", False),
        ("5 George Street, Sydney NSW 2000", "5 George St, Sydney NSW 2001", False), ("Hauptstr. 5, 10115 Berlin", "Hauptstr. 6, 10115 Berlin", False),
    ],
)
def test_addresses_of_many_countries(a, b, same):
    assert (addresses.score(addresses.parse(a), addresses.parse(b)) > 0) == same


def test_addresses_on_odd_input(spark):
    odd = ["?", ",;-", "12", "street", "12 street", "x" * 30_000, None, "Unit"]
    assert addresses.clusters(products(spark, odd)).count() == 7
    assert addresses.found(products(spark, ["a"]).limit(0)).count() == 0


# ---- graphs


def test_components_and_stars(spark):
    chain = [(i, i + 1, 1.0) for i in range(40)] + [(100, 101, 1.0)]
    edges = spark.createDataFrame(chain, "a long, b long, w double")
    got = {r["id"]: r["component"] for r in graph.connected_components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    hub = spark.createDataFrame([(0, i, 1.0) for i in range(1, 200)] + [(5, 300, 2.0)], "a long, b long, w double")
    rank = spark.createDataFrame([(300, 9)], "id long, grade int")
    stars = {r["id"]: r["center"] for r in graph.star_clusters(hub, rank).collect()}
    assert stars[300] == 300 and stars[5] == 300 and stars[7] == 0 and stars[0] == 0


# ---- listings

PRODUCT = "id string, is_active boolean, country_id int, regulator string, product_name string, brand_name string, generic_name string, active_ingredients array<string>, strengths array<string>, dosage_forms array<string>, registration_number string, mah_name string, market string"
LISTING = "listing_id long, item_name string, generic_hint string, trade_name string, licence_ref string, holder string, market string, id string"


def tables(spark, listings):
    rows = [
        ("p1", True, 3, "TGA", "Omfremoxon 75 mg film-coated tablet", "Omfremoxon", "CRITAPRAZUNE", ["critaprazune"], ["75 mg"], ["film-coated tablet"], "1000213", "Morymo Ltd", "m"),
        ("p2", True, 3, "TGA", "Omfremoxon 75 mg tablet", "Omfremoxon", "critaprazune", ["critaprazune"], ["75 mg"], ["tablet"], "1000214", "Morymo Ltd", "m"),
        ("p3", True, None, "MHRA", "Zincolin Baroliruskex 5 mg/25 microgram cream", None, "zincolin/tamuril", ["zincolin", "tamuril"], None, None, None, "Klaus Baroliruskex", "m"),
        ("p4", False, 3, "TGA", "Omfremoxon 50 mg tablet", "Omfremoxon", None, None, None, None, None, None, "m"),
        ("p5", True, 3, "TGA", None, None, None, None, None, None, None, None, "m"),
    ]
    geography = spark.createDataFrame([(3, "Australia", "AU", "TGA"), (4, "United Kingdom", "GB", "MHRA")], "id int, country_name string, country_code string, agency_acronym string")
    return spark.createDataFrame(listings, LISTING), spark.createDataFrame(rows, PRODUCT), geography


@pytest.mark.parametrize(
    "listing, want",
    [
        (("FC tab 75mg, Omfremoxno", None, "Omfremoxno", None, None, "Australia"), "p1"), (("OMFREMOXON TABS 0.075 G", "critaprazune hydrochloride", None, None, "Morymo", "AU"), "p2"),
        (("Omfremoxon 50 mg tablet", None, None, None, None, "AU"), None), (("Omfremoxon 75 mg tabs", None, None, None, None, "UK"), None), (("Omfremoxon 75 mg tabs", "pibleprazune", None, None, None, "AU"), None),
        (("zincolin + tamuril Baroliruskex 5mg + 25mcg crm", None, None, "see pack", None, "UK"), "p3"), ((None, None, None, None, None, None), None), (("", "", "", "", "", ""), None),
    ],
)
def test_listing(spark, listing, want):
    got = linkage.found(*tables(spark, [(7, *listing, "id"), (8, "Unheard 1 mg tablet", None, None, None, None, "AU", "id")])).collect()
    assert [tuple(r) for r in got] == ([(7, want)] if want else [])


def test_a_silent_market_stands_for_any(spark):
    said = ("Omfremoxon 75 mg FC tab", "critaprazune", "Omfremoxon")
    listings, rows, geography = tables(spark, [
        (1, *said, "1000213", "Morymo Ltd", None, "id"), (2, *said, None, None, "", "id"), (3, *said, "1000213", None, "Austrlia", "id"), (4, *said, "1000213", "Morymo Ltd", "UK", "id"),
        (5, "Nowherin 20 mg capsule", None, "Nowherin", "777888", None, "AU", "id"), (6, "Nowherim 20 mg capsule", None, None, None, None, "UK", "id"),
        (7, *said, None, None, "Austrlia", "id"), (8, *said, "1000213", None, "Atlantis", "id"), (9, *said, None, None, "Atlantis", "id"),
    ])
    nowhere = spark.createDataFrame([("p9", True, None, None, "Nowherin 20 mg capsule", "Nowherin", None, None, ["20 mg"], ["capsule"], "777888", None, "m")], PRODUCT)
    assert {tuple(r) for r in linkage.found(listings, rows.unionByName(nowhere), geography).collect()} == {(1, "p1"), (2, "p1"), (3, "p1"), (5, "p9"), (6, "p9"), (7, "p1"), (8, "p1")}


def test_listings_copies_and_none(spark):
    same = [(i, "Omfremoxon 75 mg FC tab", None, "Omfremoxon", None, None, "AU", "x") for i in range(50)]
    out = linkage.linked(*tables(spark, same)).collect()
    assert len(out) == 50 and {r["product_id"] for r in out} == {"p1"} and min(r["confidence"] for r in out) > 0.7
    listings, rows, geography = tables(spark, same)
    assert linkage.found(listings.limit(0), rows, geography).count() == 0 and linkage.found(listings, rows.limit(0), geography).count() == 0


def test_field_against_brute_force():
    import numpy as np

    rng = np.random.default_rng(3)
    features = rng.uniform(0, 1, (4, len(linkage.FEATURES)))
    field = linkage.HingeField(np.array([0, 0, 1, 1]), np.array([0, 1, 0, 2]), np.ones(4), features)
    x = field.solve()

    def energy(z):
        y = [(z[0] + z[2]) / 2, z[1], z[3]]
        loss = (field.w * np.maximum(field.sign * z + field.offset, 0)).sum()
        return loss + linkage.W_TRANSITIVE * sum(abs(z[i] - y[t]) for i, t in enumerate((0, 1, 0, 2)))

    grid = np.linspace(0, 1, 21)
    best = min(energy(np.array(z)) for z in itertools.product(grid, repeat=4) if z[0] + z[1] <= 1 and z[2] + z[3] <= 1)
    assert x[0] + x[1] <= 1.002 and x[2] + x[3] <= 1.002 and energy(x) <= best + 0.01


def test_hot_keys_meet_the_same(spark):
    near = spark.createDataFrame([(1, i) for i in range(40)] + [(2, i) for i in range(5)] + [(3, 99)], "k long, evidence long")
    far = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "c"), (4, "d")], "k long, product_id string")
    plain = pairs(linkage._meet(near, far, 41))
    assert pairs(linkage._meet(near, far, 41, hot_rows=7)) == plain and len(plain) == 85


def test_field_settles_as_shipped():
    """The decisions at the shipped residual are those of a hundred times smaller one."""
    import numpy as np

    rng, differ, n = np.random.default_rng(1), 0, 60
    for _ in range(4):
        listing = np.sort(rng.integers(0, 25, n))
        features = rng.choice([-1, 0, 0.3, 0.7, 0.85, 0.9, 1.0, 1.0, 1.0], (n, 6))
        features[:, 0] = rng.uniform(0.6, 1, n)
        field = linkage.HingeField(listing, rng.integers(0, 12, n), rng.choice([1.0, 2.0, 5.0, 300.0], 25)[listing], features)
        a, b = field.solve(), field.solve(settled=linkage.SETTLED / 100)
        differ += int(((a >= linkage.ACCEPT) != (b >= linkage.ACCEPT)).sum())
        for i in range(25):
            assert a[listing == i].sum() <= 1.05
    assert differ <= 3


def test_groups_are_solved_as_if_alone():
    import numpy as np

    rng = np.random.default_rng(2)
    features = rng.uniform(0.5, 1, (12, 6))
    listing, tie, weight = np.repeat(np.arange(6), 2), np.tile([0, 1], 6) + 2 * np.repeat([0, 1, 2], 4), np.repeat([1.0, 4.0, 1.0, 1.0, 9.0, 2.0], 2)
    whole = linkage.HingeField(listing, tie, weight, features, np.repeat([0, 1, 2], 4)).solve()
    for g in range(3):
        of = slice(4 * g, 4 * g + 4)
        alone = linkage.HingeField(listing[of] - 2 * g, tie[of] - 2 * g, weight[of], features[of]).solve()
        assert np.abs(alone - whole[of]).max() <= 0.02


def test_columns_clash(spark):
    listings, rows, geography = tables(spark, [(1, "Omfremoxon 75 mg FC tab", None, None, None, None, "AU", "x")])
    clash = listings.withColumn("product_id", F.lit("c")).withColumn("evidence", F.lit(1)).withColumn("k", F.lit(1))
    assert [tuple(r) for r in linkage.found(clash, rows.withColumn("tie", F.lit(2)), geography).collect()] == [(1, "p1")]
