"""Dimension parameters: topics with keyword taxonomies, sentiment lexicons.

These are small parameter tables supplied by the caller (bounded by the
taxonomy, never by the data), so broadcasting or inlining them is safe.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Field weights and saturation of the topic score, the default
# topic taxonomy (topics in id order, keywords in their given order).
# ---------------------------------------------------------------------------
FIELD_WEIGHTS_TENTHS = {"title": 5, "summary": 3, "content": 2}   # 0.5 / 0.3 / 0.2
TOPIC_SATURATION_TENTHS = 30                                       # 3.0 hits
RELEVANCE_WEIGHTS_TENTHS = (8, 2)                                  # 0.8 top-1, 0.2 top-2

DEFAULT_TAXONOMY: list[tuple[str, list[str]]] = [
    ("oil_market", ["oil", "brent", "wti", "crude", "barrel", "petroleum", "refinery",
                    "energy market", "energy", "baker hughes", "tanker", "tankers",
                    "shipping", "shipment", "maritime", "strait of hormuz", "hormuz", "gulf",
                    "export route", "oil route", "chokepoint", "natural gas", "gas", "lng",
                    "liquefied natural gas", "power market", "electricity",
                    "power generation", "energy security", "utility", "utilities",
                    "reactor", "nuclear"]),
    ("economy", ["inflation", "gdp", "interest rate", "central bank", "recession", "growth",
                 "economy", "economic", "macro", "unemployment", "federal reserve", "fed",
                 "ecb", "boj", "bank of japan"]),
    ("war", ["war", "military", "missile", "attack", "conflict", "invasion", "troops",
             "strike", "naval", "blockade"]),
    ("sanctions", ["sanction", "embargo", "restriction", "blacklist", "price cap", "ban"]),
    ("tariffs", ["tariff", "duties", "import tax", "trade barrier", "customs duty"]),
    ("supply", ["supply", "production", "output", "opec", "opec+", "inventory", "stocks",
                "drilling", "exports", "export", "shipping", "shipment", "disruption",
                "closure", "reopen", "reopening", "transit", "capacity", "generation",
                "electricity generation", "power generation", "reactor restart", "restart"]),
    ("demand", ["demand", "consumption", "industrial activity", "travel demand",
                "aviation demand", "imports", "usage", "electricity demand", "power demand",
                "gas demand", "fuel demand", "displace", "displacing"]),
]

# Test taxonomy and lexicon whose words occur in the synthetic
# documents (the default keywords never do).
TEST_TAXONOMY: list[tuple[str, list[str]]] = [
    ("t_en", ["the", "of the", "to the"]),
    ("t_es", ["la", "de la", "que"]),
    ("t_de", ["der", "und", "die"]),
    ("t_mix", ["en", "que"]),
]
TEST_LEXICON = {"with": 1.6, "this": 2.0, "was": -1.8, "from": -1.1, "pour": 1.4,
                "und": 0.9, "die": -1.3, "que": 1.1}
TEST_NEGATORS = ["that"]
TEST_BOOSTERS = {"are": 0.293}

# Fixed values of the published lexicon method (Hutto and Gilbert 2014).
BOOSTER_INCREMENT = 0.293
NEGATION_SCALAR = -0.74
BOOSTER_DAMPING = (1.0, 0.95, 0.9)     # distance 1, 2, 3
CONTRAST_WORD = "but"
CONTRAST_BEFORE, CONTRAST_AFTER = 0.5, 1.5
NORMALIZATION_ALPHA = 15.0


@dataclass(frozen=True)
class Taxonomy:
    topics: list[tuple[str, list[str]]]

    @property
    def topic_ids(self) -> list[tuple[int, str]]:
        return [(i + 1, name) for i, (name, _) in enumerate(self.topics)]

    @property
    def keywords(self) -> list[str]:
        """Distinct keywords, first-seen order."""
        seen: dict[str, None] = {}
        for _, kws in self.topics:
            for k in kws:
                seen.setdefault(k.strip().lower(), None)
        return list(seen)

    def sorted_keywords(self, topic: str) -> list[str]:
        for name, kws in self.topics:
            if name == topic:
                return sorted({k.strip().lower() for k in kws})
        raise KeyError(topic)


@dataclass(frozen=True)
class Lexicon:
    valence: dict[str, float]
    boosters: dict[str, float] = field(default_factory=dict)
    negators: list[str] = field(default_factory=list)


def test_taxonomy() -> Taxonomy:
    return Taxonomy(TEST_TAXONOMY)


def default_taxonomy() -> Taxonomy:
    return Taxonomy(DEFAULT_TAXONOMY)


def test_lexicon() -> Lexicon:
    return Lexicon(dict(TEST_LEXICON), dict(TEST_BOOSTERS), list(TEST_NEGATORS))


def read_lexicon_tsv(spark, path: str, boosters: dict[str, float] | None = None,
                     negators: list[str] | None = None) -> Lexicon:
    """Read a 'token<TAB>mean[<TAB>...]' lexicon file through Spark, so any
    storage works; a published lexicon has some thousand entries, and it is a
    parameter of the plans, so it is held on the driver.  Later lines win."""
    from pyspark.sql import functions as F
    part = F.split("value", "\t")
    rows = spark.read.text(path).select(
        F.monotonically_increasing_id().alias("at"), F.lower(part[0]).alias("token"),
        F.get(part, F.lit(1)).try_cast("double").alias("mean"))
    kept = rows.where("token <> '' and mean is not null").orderBy("at").collect()
    return Lexicon({r.token: r.mean for r in kept}, boosters or {}, negators or [])


def topics_frame(spark, taxonomy: Taxonomy):
    """The topic dimension (topic_id, topic_name)."""
    return spark.createDataFrame(taxonomy.topic_ids, "topic_id int, topic_name string")


def keywords_frame(spark, taxonomy: Taxonomy):
    """The taxonomy as a long table (topic_id, topic_name, keyword)."""
    rows = [(i + 1, name, k) for i, (name, kws) in enumerate(taxonomy.topics) for k in kws]
    return spark.createDataFrame(rows, "topic_id int, topic_name string, keyword string")
