"""Sources: each turns raw payloads into rows of one document schema; a registry joins them.

Fetching is outside the engine: payloads come as files or tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainloom.functions.text import strip
from grainloom.session import numbered, settled

DOCUMENT = ("source", "source_id", "url", "title", "content", "metadata", "content_hash")


def _documents(rows: DataFrame, source: str, source_id: Column, url: Column, title: Column, content: Column, metadata: dict[str, Column]) -> DataFrame:
    """The document schema; metadata is a map of JSON text, so that sources of any shape unite."""
    entries = [F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in metadata.items()]
    meta = F.map_from_entries(F.array(*entries)) if entries else F.create_map().cast("map<string,string>")
    return rows.select(F.lit(source).alias("source"), source_id.cast("string").alias("source_id"), url.alias("url"), title.alias("title"), content.alias("content"), meta.alias("metadata"), F.sha2(content, 256).alias("content_hash"))


def jsonl(spark: SparkSession, path: str, schema: str | None = None, malformed: str = "FAILFAST") -> DataFrame:
    """Every *.jsonl, and every part that the sinks wrote, below path. A missing path raises; a blank line is no row; bad lines raise or, by DROPMALFORMED, go."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "{*.jsonl,part-*.json}").option("mode", malformed)
    return (reader.schema(schema) if schema else reader).json(path)


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def training_set(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, or JSON lines where the folder has none."""
    try:
        return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)
    except Exception as e:
        if "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return jsonl(spark, path)


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """(url) of a text file; blank lines go, and lines that start with #, before any stripping."""
    lines = spark.read.text(path)
    return lines.where(~F.startswith("value", F.lit("#"))).select(strip(F.col("value")).alias("url")).where("url != ''")


def weights(spark: SparkSession, path: str) -> DataFrame:
    """(param, values) of a folder of shards, in the order of their names: of a parameter in several the last wins. A missing path raises."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(path).select("param", "values", F.col("_metadata.file_path").alias("_file"))
    return rows.groupBy("param").agg(F.max_by("values", "_file").alias("values"))


ATOM_ENTRY = "struct<id:string,title:string,summary:string,published:string,author:array<struct<name:string>>,category:array<struct<_term:string>>,link:array<struct<_href:string,_rel:string,_title:string>>>"


def atom(feeds: DataFrame, first: str = "", last: str = "9999", most: int | None = None) -> DataFrame:
    """Papers of Atom feeds (xml): published between two dates, both included, as text; of what is left the `most` newest, ties by id."""
    entry = F.explode(F.from_xml(F.col("xml"), f"entry array<{ATOM_ENTRY}>", {"rowTag": "feed"})["entry"]).alias("e")
    rows = feeds.select(entry).select("e.*").where(F.substring("published", 1, 10).between(first, last))
    link = lambda pick: F.get(F.transform(F.filter("link", pick), lambda x: x["_href"]), 0)
    title, summary = strip(F.coalesce("title", F.lit(""))), strip(F.coalesce("summary", F.lit("")))
    if most:
        rows = rows.orderBy(F.col("published").desc(), "id").limit(most)
    content = F.concat(F.lit("Title: "), title, F.lit("\n\nAbstract: "), summary)
    meta = {"authors": F.to_json(F.transform("author", lambda a: a["name"])), "categories": F.to_json(F.transform("category", lambda c: c["_term"])), "published": F.col("published"), "pdf_url": link(lambda x: x["_title"] == "pdf")}
    return _documents(rows, "arxiv", F.element_at(F.split("id", "/"), -1), F.coalesce(link(lambda x: x["_rel"] == "alternate"), "id"), title, content, meta)


#: What stands between comments and answers, and the mark of an accepted answer.
BETWEEN, ACCEPTED = "\n\n---\n\n", "  \u2713 Accepted"


def issues(rows: DataFrame, most_comments: int = 10) -> DataFrame:
    """Issues (repo, number, html_url, title, body, labels, pull_request, comments array<struct<user, body>>): no pull requests, with the first comments."""
    own = rows.where("pull_request IS NULL")
    text = lambda c: F.coalesce(c, F.lit(""))
    said = F.transform(F.slice(F.coalesce("comments", F.array().cast(dict(rows.dtypes)["comments"])), 1, most_comments), lambda c: F.concat(F.lit("**"), F.coalesce(c["user"], F.lit("unknown")), F.lit("**: "), text(c["body"])))
    content = F.concat(F.lit("Issue: "), text(F.col("title")), F.lit("\n\nLabels: "), text(F.array_join("labels", ", ")), F.lit("\n\nBody:\n"), text(F.col("body")), F.lit("\n\nComments:\n"), F.array_join(said, BETWEEN))
    source_id = F.concat("repo", F.lit("/issues/"), F.col("number").cast("string"))
    return _documents(own, "github", source_id, F.col("html_url"), F.col("title"), content, {"repo": F.col("repo"), "type": F.lit("issue"), "labels": F.to_json("labels")})


def questions(rows: DataFrame, least_score: int = 0, answers: int = 5) -> DataFrame:
    """Questions (question_id, link, title, body, score, tags, answers array<struct<score, is_accepted, body>>) with their best answers; of equal ones the first."""
    text = lambda c: F.coalesce(c, F.lit(""))
    listed = F.transform(F.coalesce("answers", F.array().cast(dict(rows.dtypes)["answers"])), lambda a, i: F.struct((-a["score"]).alias("k"), i.alias("i"), a["score"].alias("score"), a["is_accepted"].alias("ok"), a["body"].alias("body")))
    texts = F.transform(F.slice(F.array_sort(listed), 1, answers), lambda a: F.concat(F.lit("[Score: "), a["score"].cast("string"), F.when(a["ok"], F.lit(ACCEPTED)).otherwise(""), F.lit("]\n"), text(a["body"])))
    content = F.concat(
        F.lit("Question: "), F.col("title"), F.lit("\nTags: "), text(F.array_join("tags", ", ")), F.lit("\nScore: "), F.col("score").cast("string"), F.lit("\n\n"), text(F.col("body")),
        F.lit("\n\n" + "=" * 40 + "\nAnswers:\n"), F.array_join(texts, BETWEEN),
    )
    own = rows.where(F.col("score") >= least_score)
    link = F.coalesce("link", F.concat(F.lit("https://stackoverflow.com/q/"), F.col("question_id").cast("string")))
    return _documents(own, "stackoverflow", F.col("question_id"), link, F.col("title"), content, {"score": F.col("score"), "tags": F.to_json("tags")})


#: The fields of a dataset's rows that are read, in this order.
FIELDS = ("text", "instruction", "input", "output", "response", "question", "answer", "context", "conversations")


def hub_rows(rows: DataFrame, dataset: str, fields: tuple[str, ...] = FIELDS, most: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Rows of a dataset: every field that isn't empty as `field: value`, each turn of an array as `[role]: text`, a blank line between.

    Empty rows don't count; the others are numbered in order (by default that of all fields), which gives their ids, and
    the first `most` are taken.
    """
    kinds = dict(rows.dtypes)
    have = [f for f in fields if f in kinds]

    def part(name: str) -> Column:
        if not kinds[name].startswith("array<struct"):
            value = F.col(name).cast("string")
            return F.when(F.coalesce(value, F.lit("")) != "", F.array(F.concat(F.lit(f"{name}: "), value))).otherwise(F.array().cast("array<string>"))
        role = next((r for r in ("from", "role") if f"{r}:" in kinds[name]), None)
        value = next((v for v in ("value", "content") if f"{v}:" in kinds[name]), None)
        text = lambda t, f: F.coalesce(t[f], F.lit("")) if f else F.lit("")
        return F.coalesce(F.transform(name, lambda t: F.concat(F.lit("["), text(t, role), F.lit("]: "), text(t, value))), F.array().cast("array<string>"))

    full = rows.withColumn("_content", F.array_join(F.flatten(F.array(*map(part, have))), "\n\n")).where("_content != ''")
    full = numbered(full, order or ["_content"], "_index")
    full = full.where(F.col("_index") < most) if most else full
    index = F.col("_index").cast("string")
    return _documents(full, "huggingface", F.concat(F.lit(f"{dataset}/"), index), F.lit(f"https://huggingface.co/datasets/{dataset}"), F.concat(F.lit(f"{dataset} - Example "), index), F.col("_content"), {"dataset": F.lit(dataset), "index": index})


def identity(fields: Column) -> Column:
    """A document's key from a map of its fields: the content hash, else the source's id, else ""."""
    of = lambda name: F.when(F.coalesce(fields[name], F.lit("")) != "", fields[name])
    return F.coalesce(of("content_hash"), of("source_id"), F.lit(""))


def text_of(fields: Column, names: tuple[str, ...] = ("text", "instruction", "prompt")) -> Column:
    """The text of a map of fields: that of the first name that is a key, even if its value is null (then ""); "" if none is."""
    out = F.lit("")
    for n in reversed(names):
        out = F.when(F.map_contains_key(fields, F.lit(n)), F.coalesce(fields[n], F.lit(""))).otherwise(out)
    return out


class _Page(HTMLParser):
    """Visible text by line, the title and links."""

    DROPPED = frozenset(("script", "style", "nav", "footer", "header"))

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.depth, self.in_title = 0, False
        self.lines: list[str] = []
        self.title: list[str] = []
        self.links: list[str] = []
        self.piece: list[str] = []

    def _flush(self) -> None:
        text = "".join(self.piece).strip()
        if text:
            self.lines.append(text)
        self.piece = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._flush()
        if tag in self.DROPPED:
            self.depth += 1
        self.in_title = tag == "title"
        if tag == "a" and not self.depth:
            self.links += [v for k, v in attrs if k == "href" and v]

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        if tag in self.DROPPED and self.depth:
            self.depth -= 1
        self.in_title = False

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title.append(data)
        if not self.depth:
            self.piece.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()


def parse_page(html: str) -> tuple[str, str, list[str]]:
    """(text, title, links): text nodes stripped and joined by line, without scripts, styles, navigation, header and footer."""
    page = _Page()
    page.feed(html or "")
    page.close()
    page._flush()
    return "\n".join(page.lines), "".join(page.title).strip(), page.links


def absolute(url: str | None, links: list[str]) -> list[str]:
    """Links resolved against the page's address; only http and https ones."""
    out = []
    for link in links:
        try:
            to = urljoin(url or "", link)
            if urlsplit(to).scheme in ("http", "https"):
                out.append(to)
        except ValueError:
            continue
    return out


def html_pages(pages: DataFrame) -> DataFrame:
    """pages (url, html) with text, title and absolute http links."""

    def parsed(url: pd.Series, html: pd.Series) -> pd.DataFrame:
        found = [parse_page(h) for h in html]
        return pd.DataFrame([(text, title, absolute(u, links)) for u, (text, title, links) in zip(url, found, strict=True)], columns=["text", "title", "links"])

    parse = F.pandas_udf(parsed, "text string, title string, links array<string>")
    return pages.withColumn("_p", parse("url", "html")).select(*pages.columns, "_p.text", "_p.title", "_p.links")


def crawled(pages: DataFrame, least_chars: int = 100) -> DataFrame:
    """Documents of pages (url, html) whose text is long enough; the title falls back to the URL's path."""
    rows = html_pages(pages).where(F.length("text") >= least_chars)
    title = F.when(F.coalesce("title", F.lit("")) != "", F.col("title")).otherwise(F.parse_url("url", F.lit("PATH")))
    return _documents(rows, "custom", F.md5("url"), F.col("url"), title, F.col("text"), {"domain": F.parse_url("url", F.lit("AUTHORITY"))})


def crawl_order(pages: DataFrame, seeds: DataFrame, max_depth: int, least_chars: int = 100) -> DataFrame:
    """(url, depth) of pages reached from seeds (url) by links of pages long enough, each at its least depth; one round a depth."""
    found = html_pages(pages).where(F.length("text") >= least_chars)
    links = settled(found.select("url", F.explode("links").alias("to")).distinct())
    known = settled(pages.select("url").distinct())
    front = settled(seeds.select("url").distinct().join(known, "url", "left_semi").withColumn("depth", F.lit(0)))
    visited = front
    for depth in range(1, max_depth + 1):
        if front.isEmpty():
            break
        reached = links.join(front.select("url"), "url", "left_semi").select(F.col("to").alias("url")).distinct()
        front = settled(reached.join(known, "url", "left_semi").join(visited.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth)))
        visited = settled(visited.union(front))
    return visited


#: Builders by source type.
REGISTRY: dict[str, Callable[..., DataFrame]] = {"arxiv": atom, "github": issues, "stackoverflow": questions, "huggingface": hub_rows, "custom": crawled}


def ingest(payloads: Mapping[str, tuple[DataFrame, dict]]) -> DataFrame:
    """The union of all sources {type: (payload, options)}; types that aren't registered are skipped."""
    out: DataFrame | None = None
    for kind, (rows, options) in payloads.items():
        if kind in REGISTRY:
            more = REGISTRY[kind](rows, **options)
            out = more if out is None else out.unionByName(more)
    if out is None:
        raise ValueError(f"none of {sorted(payloads)} is a registered source")
    return out
