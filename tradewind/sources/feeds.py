"""Landed feed files (A1-A4, A15): RSS / Atom XML, search-API and timeline JSON.

Fetching is out of scope: jobs start from response bodies already landed in
storage, one poll per file (a JSON file may also hold one body per line).  A
file is read whole (a poll is a bounded page of items) and its items keep
their place: ``feed_file`` and ``position`` order them within a source.

Every item is judged by itself: a malformed item, a missing link or a title
that is empty after cleaning rejects that item only, with its reason;
``rejects`` counts them per file (a body that cannot be parsed is one reject).

XML feeds are read tolerantly, as feeds in the wild are.  The body is cut into
its items first (RSS, RDF with items beside the channel, Atom), so a broken
item cannot take others with it, and an item that the end of the file cuts off
is one reject.  Undefined entities, bare ``&`` and ``<``, and control
characters are mended before an item is parsed; declared Latin-1 and UTF-16
bodies are decoded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import iso_local_date, parse_iso, parse_rfc822
from ..functions.text import strip_html, url_hash
from ..session import child_names

# Routing of API sources and the search API's item URL format.
SEARCH_API_DOMAIN = "hn.algolia.com"
TIMELINE_API_DOMAIN = "mastodon.social"
SEARCH_ITEM_URL = "https://news.ycombinator.com/item?id="
SEARCH_GUID_PREFIX = "hn_"
TIMELINE_GUID_PREFIX = "mastodon_"
TIMELINE_TITLE_CHARS = 120
DEFAULT_LANGUAGE = "en"

ARTICLE_COLUMNS = ["source_id", "position", "external_guid", "url", "url_hash", "title",
                   "summary", "content", "author_name", "language_code", "published_at",
                   "published_date"]

ITEM_COLUMNS = ["tags", "links", "raw_payload", "feed_file"]


def _xml(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_S, _LIST = T.StringType(), T.ArrayType(T.StringType())
RSS_ITEM = _xml(**{
    "title": _S, "link": _S, "guid": _S, "_rdf:about": _S, "pubDate": _S, "dc:date": _S,
    "updated": _S, "description": _S, "content:encoded": _S, "author": _S, "dc:creator": _S,
    "category": _LIST, "_corrupt_record": _S})
ATOM_LINK = _xml(_href=_S, _rel=_S)
ATOM_ENTRY = _xml(
    title=_S, id=_S, link=T.ArrayType(ATOM_LINK), published=_S, updated=_S, summary=_S,
    content=_S, author=T.ArrayType(_xml(name=_S)), category=T.ArrayType(_xml(_term=_S)),
    _corrupt_record=_S)

PREFIX = r"(?:[\w.\-]+:)?"
ITEM_START = rf"<{PREFIX}(?:item|entry)[\s/>]"
ITEM_END = rf"</{PREFIX}(?:item|entry)\s*>"
#: Code points 128 to 159 of the encodings that call themselves Latin-1.
LATIN = "".join(map(chr, range(128, 160)))
WINDOWS = bytes(range(128, 160)).decode("cp1252", "replace")

# Names of the sources and fields of the stored payloads.
SEARCH_PAYLOAD_API, TIMELINE_PAYLOAD_API = "hacker_news_algolia", "mastodon"
SEARCH_FIELDS = {"objectID": "string", "title": "string", "story_title": "string",
                 "url": "string", "author": "string", "points": "bigint",
                 "num_comments": "bigint", "created_at": "string", "story_text": "string",
                 "comment_text": "string"}
TIMELINE_FIELDS = {"id": "string", "url": "string", "created_at": "string",
                   "content": "string", "language": "string", "replies_count": "bigint",
                   "reblogs_count": "bigint", "favourites_count": "bigint"}


def _first_nonempty(*cols):
    """Python's ``a or b or c`` (empty strings fall through)."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def _source_of_path(col="_metadata.file_path"):
    return F.regexp_extract(F.col(col), r"source_id=([^/]+)", 1)


def _feed_time(*cols):
    """I4: the first of the dates that parses, as RFC 822 or ISO 8601."""
    return F.coalesce(*[f(c) for c in cols for f in (parse_rfc822, parse_iso)])


def _decoded(content: Column) -> Column:
    """The text of a landed body, by its byte order mark or declared encoding."""
    plain = content.cast("string")
    mark = F.hex(F.substring(content, 1, 2))
    declared = F.lower(F.regexp_extract(
        F.substring(plain, 1, 200), r"""encoding\s*=\s*["']([\w\-]+)""", 1))
    return (F.when(mark.isin("FEFF", "FFFE"), F.decode(content, "UTF-16"))
            .when(declared.isin("iso-8859-1", "latin-1", "latin1", "windows-1252", "cp1252"),
                  F.translate(F.decode(content, "ISO-8859-1"), LATIN, WINDOWS))
            .otherwise(F.make_valid_utf8(plain)))


def _plain_xml(body: Column) -> Column:
    """A body without CDATA sections (their text escaped instead), comments and
    control characters, with bare ampersands, undefined entities and bare
    less-than signs escaped."""
    escaped = lambda c: reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), (
        ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")), c)

    def section(part: Column) -> Column:
        inside = F.substring_index(part, "]]>", 1)
        return F.concat(escaped(inside), F.substr(part, F.char_length(inside) + F.lit(4)))
    parts = F.split(body, r"<!\[CDATA\[", -1)
    joined = F.when(F.contains(body, F.lit("<![CDATA[")), F.concat(
        F.get(parts, F.lit(0)), F.array_join(F.transform(
            F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), section), ""))).otherwise(body)
    # comments, characters that XML has not got, and references to them
    gone = (r"(?s)<!--.*?-->|[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]"
            r"|&#(?:0*(?:[0-8]|1[124-9]|2\d|3[01])|x0*(?:[0-8]|[bcefBCEF]|1[0-9a-fA-F]));")
    mends = ((gone, ""), (r"&(?!(?:amp|lt|gt|quot|apos|#\d{1,7}|#x[0-9a-fA-F]{1,6});)", "&amp;"),
             (r"<(?![A-Za-z_/!?])", "&lt;"))
    return reduce(lambda x, m: F.regexp_replace(x, *m), mends, joined)


def _xml_items(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """feed_file, language, position and the parsed item, ``rss`` or ``atom``; a body
    without items that is no feed is one row with neither."""
    bodies = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
              .select(F.col("path").alias("feed_file"), _plain_xml(_decoded(
                  F.col("content"))).alias("body")))
    # every step is a column of its own: the functions over arrays would repeat it
    cut = bodies.select("feed_file", F.split("body", f"(?={ITEM_START})", -1).alias("all")).select(
        "feed_file", F.transform("all", lambda p: F.struct(p.alias("text"), F.rlike(
            p, F.lit(f"^{ITEM_START}")).alias("is_item"))).alias("all")).select(
        "feed_file", F.transform(F.filter("all", lambda p: p["is_item"]), lambda p: p["text"])
        .alias("parts"), F.transform(F.filter("all", lambda p: ~p["is_item"]), lambda p: p["text"])
        .alias("head"))

    def own_length(p: Column) -> Column:
        """Characters up to the item's own end; 0 if it has none."""
        plain = [F.locate(end, p) + F.lit(len(end) - 1) for end in ("</item>", "</entry>")]
        other = F.regexp_extract(p, rf"(?s)^(?:<[^<>]*/>|.*?{ITEM_END})", 0)
        return F.when((F.locate("</item>", p) > 0) & F.startswith(p, F.lit("<item")), plain[0]).when(
            (F.locate("</entry>", p) > 0) & F.startswith(p, F.lit("<entry")), plain[1]).otherwise(
            F.char_length(other))
    sized = cut.withColumn("parts", F.transform("parts", lambda p: F.struct(
        p.alias("text"), own_length(p).alias("n"))))
    cut = sized.withColumn("items", F.transform("parts", lambda p: F.struct(
        F.substr(p["text"], F.lit(1), p["n"]).alias("own"),
        F.substr(p["text"], p["n"] + F.lit(1)).alias("rest"),
        F.rlike(p["text"], F.lit(rf"^<{PREFIX}item")).alias("is_rss"))))
    # what stands around the items; the rest of an item that is cut off is its own
    around = F.concat(F.array_join("head", ""), F.array_join(F.transform(
        F.filter("items", lambda i: i["own"] != ""), lambda i: i["rest"]), ""))
    cut = cut.withColumn("around", around)
    language = F.coalesce(
        _first_nonempty(F.trim(F.regexp_extract(
            "around", r"<(?:dc:)?language(?:\s[^<>]*)?>([^<]*)<", 1))),
        _first_nonempty(F.regexp_extract(
            "around", rf"""<{PREFIX}feed\s[^<>]*?xml:lang\s*=\s*["']([^"']*)""", 1)))
    is_feed = F.rlike("around", F.lit(rf"<{PREFIX}(?:rss|RDF|feed)[\s/>]")) & F.rlike(
        "around", F.lit(rf"(?s)(?:</{PREFIX}(?:rss|RDF|feed)\s*>|/>)\s*\z"))
    items = F.when((F.size("items") > 0) | is_feed, F.col("items")).otherwise(
        F.array(F.struct(F.lit("").alias("own"), F.lit("").alias("rest"), F.lit(True).alias("is_rss"))))
    rows = cut.select("feed_file", language.alias("language"), F.posexplode(items).alias(
        "position", "i"))
    options = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "true"}
    parse = lambda kind, schema: F.when(
        (F.col("i.own") != "") & (F.col("i.is_rss") == kind), F.from_xml("i.own", schema, options))
    return rows.select("feed_file", "language", "position", parse(True, RSS_ITEM).alias("rss"),
                       parse(False, ATOM_ENTRY).alias("atom"))


def _shaped(rows: DataFrame, **values) -> DataFrame:
    """The common article shape with the reason why an item is rejected."""
    out = rows.withColumns(values).withColumns({
        "source_id": _source_of_path("feed_file"), "url_hash": url_hash("url"),
        "position": F.col("position").cast("long")})
    reason = (F.when(F.col("_broken"), "not an item")
              .when(F.col("url").isNull(), "no link")
              .when(F.col("title").isNull(), "no title"))
    return out.select(*ARTICLE_COLUMNS, *ITEM_COLUMNS, reason.alias("reject_reason"))


def rss_items(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A1: every item of RSS and RDF feeds and every Atom ``<entry>``, judged."""
    rss = lambda c: F.col("rss").getField(c)
    atom = lambda c: F.col("atom").getField(c)
    none = F.array().cast(_LIST)
    links = F.filter(F.coalesce(atom("link"), F.array().cast(T.ArrayType(ATOM_LINK))),
                     lambda x: x["_href"] != "")
    # the entry's own page: the first link that is not of another kind
    own = F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    link = F.coalesce(_first_nonempty(rss("link")), F.get(F.transform(
        F.concat(own, links), lambda x: x["_href"]), F.lit(0)))
    terms = F.transform(F.coalesce(atom("category"), F.array().cast(
        ATOM_ENTRY["category"].dataType)), lambda x: x["_term"])
    # one shape of both kinds, before any cleaning
    raw = _xml_items(spark, path).select(
        "feed_file", "language", "position",
        ((F.col("rss").isNull() & F.col("atom").isNull()) | rss("_corrupt_record").isNotNull()
         | atom("_corrupt_record").isNotNull()).alias("broken"),
        F.coalesce(_first_nonempty(rss("guid")), _first_nonempty(rss("_rdf:about")),
                   _first_nonempty(atom("id"))).alias("guid"),
        F.coalesce(rss("title"), atom("title")).alias("raw_title"), link.alias("link"),
        F.coalesce(rss("description"), atom("summary")).alias("raw_summary"),
        F.coalesce(rss("content:encoded"), atom("content")).alias("raw_content"),
        F.coalesce(rss("pubDate"), rss("dc:date"), atom("published")).alias("raw_published"),
        F.coalesce(rss("updated"), atom("updated")).alias("raw_updated"),
        _feed_time(rss("pubDate"), rss("dc:date"), rss("updated"), atom("published"),
                   atom("updated")).alias("ts"),
        F.coalesce(_first_nonempty(rss("author"), rss("dc:creator")),
                   F.get(atom("author"), F.lit(0))["name"]).alias("author"),
        F.filter(F.concat(F.coalesce(rss("category"), none), terms), lambda x: x != "").alias("tag"),
        F.when(F.col("atom").isNull(), F.array_compact(F.array(link))).otherwise(
            F.transform(links, lambda x: x["_href"])).alias("link_list"),
        F.col("atom").isNotNull().alias("is_atom"))
    # an entry without a summary is summarised by its content
    summary = strip_html(F.coalesce("raw_summary", F.when(F.col("is_atom"), F.col("raw_content"))))
    return _shaped(
        raw, _broken=F.col("broken"), external_guid=F.col("guid"), url=F.col("link"),
        title=strip_html("raw_title"), summary=summary,
        content=F.coalesce(strip_html("raw_content"), summary), author_name=F.col("author"),
        language_code=F.col("language"), published_at=F.col("ts"),
        published_date=F.to_date("ts"), tags=F.col("tag"), links=F.col("link_list"),
        raw_payload=F.to_json(F.struct(
            F.col("guid").alias("entry_id"), F.col("raw_title").alias("title"),
            F.col("raw_summary").alias("summary"), F.col("raw_published").alias("published"),
            F.col("raw_updated").alias("updated"), "author", F.col("tag").alias("tags"),
            F.col("link_list").alias("links")), {"ignoreNullFields": "false"}))


def _bodies(spark: SparkSession, path: str) -> DataFrame:
    """(feed_file, line, body variant): each line of a file whose first line is
    a JSON document, else the whole file; null bodies could not be parsed."""
    files = (spark.read.text(path, wholetext=True, recursiveFileLookup=True)
             .select(F.col("_metadata.file_path").alias("feed_file"), "value"))
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")
    # the parser stops at the end of the first document: look at the first line
    by_line = F.try_parse_json(F.get(lines, F.lit(0))).isNotNull()
    parts = F.when(by_line, lines).otherwise(F.array("value"))
    return files.select("feed_file", F.posexplode(parts).alias("line", "text")).select(
        "feed_file", "line", F.try_parse_json("text").alias("body"))


def _elements(bodies: DataFrame, array: str) -> DataFrame:
    """One row per element of the body's array; a body without one is one row
    whose ``it`` is null."""
    items = F.coalesce(F.try_variant_get("body", array, "array<variant>"),
                       F.array(F.lit(None).cast("variant")))
    place = Window.partitionBy("feed_file").orderBy("line", "at")
    return bodies.select("feed_file", "line", F.posexplode(items).alias("at", "it")).withColumn(
        "position", F.row_number().over(place) - 1)


def _is_object(v: str):
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def _fields(names: dict[str, str]):
    return {k: F.try_variant_get("it", f"$.{k}", t) for k, t in names.items()}


def search_items(spark: SparkSession, path: str) -> DataFrame:
    """A2 + A15: the hits of ``{"hits": [...]}`` bodies, judged one by one."""
    f = _fields(SEARCH_FIELDS)
    title = strip_html(_first_nonempty(f["title"], f["story_title"]))
    oid = _first_nonempty(f["objectID"])
    # falls back to the already-cleaned title, as the reference does
    content = strip_html(_first_nonempty(f["story_text"], f["comment_text"], title))
    none = F.array().cast(_LIST)
    return _shaped(
        _elements(_bodies(spark, path), "$.hits"), _broken=~_is_object("it"),
        external_guid=F.when(oid.isNotNull(), F.concat(F.lit(SEARCH_GUID_PREFIX), oid)),
        url=F.coalesce(_first_nonempty(f["url"]), F.when(
            oid.isNotNull(), F.concat(F.lit(SEARCH_ITEM_URL), oid))),
        title=title, summary=content, content=content, author_name=f["author"],
        language_code=F.lit(DEFAULT_LANGUAGE), published_at=parse_iso(f["created_at"]),
        published_date=iso_local_date(f["created_at"]), tags=none, links=none,
        raw_payload=F.to_json(F.struct(
            F.lit(SEARCH_PAYLOAD_API).alias("source_api"),
            *[v.alias(k) for k, v in f.items()]), {"ignoreNullFields": "false"}))


def timeline_items(spark: SparkSession, path: str) -> DataFrame:
    """A3 + A15: the statuses of top-level arrays, judged one by one; an item
    needs id, url and text (its title is the text's beginning)."""
    f = _fields(TIMELINE_FIELDS)
    acct = F.try_variant_get("it", "$.account.acct", "string")
    bot = F.try_variant_get("it", "$.account.bot", "boolean")
    sid, content = _first_nonempty(f["id"]), strip_html(f["content"])
    none = F.array().cast(_LIST)
    return _shaped(
        _elements(_bodies(spark, path), "$"), _broken=~_is_object("it") | sid.isNull(),
        external_guid=F.concat(F.lit(TIMELINE_GUID_PREFIX), sid), url=_first_nonempty(f["url"]),
        title=F.substring(content, 1, TIMELINE_TITLE_CHARS), summary=content, content=content,
        author_name=acct, language_code=F.coalesce(
            _first_nonempty(f["language"]), F.lit(DEFAULT_LANGUAGE)),
        published_at=parse_iso(f["created_at"]), published_date=iso_local_date(f["created_at"]),
        tags=none, links=none, raw_payload=F.to_json(F.struct(
            F.lit(TIMELINE_PAYLOAD_API).alias("source_api"), *[v.alias(k) for k, v in f.items()],
            F.struct(acct.alias("acct"), bot.alias("bot")).alias("account")),
            {"ignoreNullFields": "false"}))


def stored_payloads(items: DataFrame, path: str) -> DataFrame:
    """I8: (source_id, feed_file, position, payload) with the payload stored as a
    variant, which is read by path without parsing the text again."""
    items.select("source_id", "feed_file", "position", F.parse_json("raw_payload").alias(
        "payload")).write.parquet(path)
    return items.sparkSession.read.parquet(path)


def accepted(items: DataFrame) -> DataFrame:
    return items.where("reject_reason is null").drop("reject_reason")


def rejects(items: DataFrame) -> DataFrame:
    """Rejected items per file and reason."""
    return items.where("reject_reason is not null").groupBy(
        "source_id", "feed_file", "reject_reason").agg(F.count(F.lit(1)).alias("rejected"))


def read_rss(spark: SparkSession, path: str) -> DataFrame:
    return accepted(rss_items(spark, path))


def read_search(spark: SparkSession, path: str) -> DataFrame:
    return accepted(search_items(spark, path))


def read_timeline(spark: SparkSession, path: str) -> DataFrame:
    return accepted(timeline_items(spark, path))


def route_sources(sources: DataFrame) -> DataFrame:
    """A4/A5: active rss/api sources with a feed; ``reader`` names the parser,
    null for unsupported (type, domain) pairs."""
    active = sources.filter(F.col("source_type").isin("rss", "api") & F.col("is_active")
                            & F.col("feed_url").isNotNull())
    reader = (F.when(F.col("source_type") == "rss", "rss")
              .when((F.col("source_type") == "api") & (F.col("domain_name") == SEARCH_API_DOMAIN),
                    "search")
              .when((F.col("source_type") == "api")
                    & (F.col("domain_name") == TIMELINE_API_DOMAIN), "timeline"))
    return active.withColumn("reader", reader)


def ingest(spark: SparkSession, sources: DataFrame, landing: str) -> DataFrame:
    """A4: the accepted items of every routable source's landed files."""
    return accepted(judged(spark, sources, landing))


def judged(spark: SparkSession, sources: DataFrame, landing: str) -> DataFrame:
    """Every item of the routable sources' landed files with its reject reason;
    only their folders are read (the registry of feeds is a bounded dimension), one
    listing per reader."""
    routed = route_sources(sources).where("reader is not null").select("reader", "source_name")
    landed: dict[str, set[str]] = {}
    folders: dict[str, list[str]] = {}
    for r in routed.toLocalIterator():
        if r.reader not in landed:
            landed[r.reader] = set(child_names(spark, f"{landing}/{r.reader}"))
        if f"source_id={r.source_name}" in landed[r.reader]:
            folders.setdefault(r.reader, []).append(
                f"{landing}/{r.reader}/source_id={r.source_name}")
    read = {"rss": rss_items, "search": search_items, "timeline": timeline_items}
    parts = [read[k](spark, v) for k, v in sorted(folders.items())]
    if not parts:
        return spark.createDataFrame([], item_schema().add("reject_reason", _S))
    return reduce(DataFrame.unionByName, parts)


def item_schema() -> T.StructType:
    kinds = {"position": T.LongType(), "published_at": T.TimestampType(),
             "published_date": T.DateType(), "tags": _LIST, "links": _LIST}
    return T.StructType([T.StructField(c, kinds.get(c, _S)) for c in ARTICLE_COLUMNS + ITEM_COLUMNS])
