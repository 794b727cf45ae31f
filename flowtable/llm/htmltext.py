"""Main text of web pages by removal of a site's templates.

Every page is read into its blocks of text and the hashes of its element subtrees.  Spark counts for each
host in how many different pages (pages with different texts; copies count once) a subtree occurs, and
subtrees that recur are deleted wherever they stand.  What markup says is a prior on what is left: elements it
names as no part of an article (menus, forms, adverts, comments and the like) go, and a declared article is
the text.  A container is template from ``MIN_PAGES`` pages on and prose from ``PROSE_PAGES`` on, however large the
host; prose inside a declared article never is: a paragraph that many articles quote stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtable.llm.common import materialize, table, text_list
from flowtable.llm.pagetree import INLINE, PROSE, flags_of, kept_blocks, parse

MIN_PAGES = 3  # different pages of a host that share a container
PROSE_PAGES = 10  # or a paragraph, heading, item or cell outside declared articles

_PARSED = ("row long, host string, page long, ups array<int>, flags array<int>, digests array<bigint>, prose array<int>, "
           "at array<int>, texts array<string>, asked array<bigint>")


def host_of(url: str | None) -> str:
    rest = (url or "").split("://", 1)[-1]
    for end in "/?#":
        rest = rest.split(end, 1)[0]
    return rest.rsplit("@", 1)[-1].lower()


def read_page(source: str) -> dict:
    """A page as arrays: of its elements those above, flags, hashes of subtrees that may be template (else null) and
    which of these are prose; of its blocks the element and the text; a hash of the text that markup alone leaves; and the
    hashes whose removal could change that text: those above a part of it, or of a page that declares no article all."""
    page = parse(source)
    digests: list[int | None] = []
    prose = []
    for i, e in enumerate(page.elements):
        may_be = i > 0 and e.tag not in INLINE and e.tag not in ("html", "body") and not (e.in_article and e.tag in PROSE)
        digests.append(e.digest if may_be else None)
        if may_be and e.tag in PROSE:
            prose.append(i)
    found = {"ups": [e.up for e in page.elements], "flags": [flags_of(e) for e in page.elements], "digests": digests, "prose": prose,
             "at": [i for i, _ in page.blocks], "texts": [t for _, t in page.blocks]}
    kept = _kept(found, set())
    found["page"] = xxhash.xxh64_intdigest(_joined(found, kept)) - (1 << 63)
    below = [0] * len(page.elements)  # kept blocks of a subtree
    for (i, _), keep in zip(page.blocks, kept):
        below[i] += keep
    declared = any(below) and all(e.in_article for e, n in zip(page.elements, below) if n)
    for i in range(len(below) - 1, 0, -1):
        below[found["ups"][i]] += below[i]
    # a subtree with all of the text recurs only in pages of the same text, which count once
    found["asked"] = list({d for d, n in zip(digests, below) if d is not None and (not below[0] or (n < below[0] and (n or not declared)))})
    return found


def _kept(page: dict, templates: set[int]) -> list[bool]:
    removed = [d is not None and d in templates for d in page["digests"]] if templates else [False] * len(page["ups"])
    return kept_blocks(page["ups"], page["flags"], removed, page["at"], [len(t) for t in page["texts"]])


def _joined(page: dict, kept: list[bool]) -> str:
    return "\n".join(t for t, keep in zip(page["texts"], kept) if keep)


def text_without(page: dict, templates: set[int]) -> str:
    """The page's main text without the subtrees whose hash is in ``templates``."""
    return _joined(page, _kept(page, templates))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    kinds = {"page": pa.int64(), "ups": ints, "flags": ints, "digests": longs, "prose": ints, "at": ints, "texts": pa.list_(pa.string()),
             "asked": longs}
    for batch in batches:
        hosts, found = [host_of(u) for u in batch.column("url").to_pylist()], [read_page(t) for t in text_list(batch.column("html"))]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page_id", "url", "row")), pa.array(hosts, pa.string()),
             *(pa.array([f[k] for f in found], kind) for k, kind in kinds.items())], ["page_id", "url", "row", "host", *kinds])


def site_templates(parsed: DataFrame, min_pages: int = MIN_PAGES, prose_pages: int = PROSE_PAGES) -> DataFrame:
    """``host, subtree`` of the subtrees that recur across a host's different pages."""
    each = parsed.select("host", "page", "prose", F.posexplode("digests").alias("i", "subtree")).where("subtree IS NOT NULL")
    return (each.select("host", "page", "subtree", F.array_contains("prose", F.col("i")).alias("is_prose")).distinct()
            .groupBy("host", "subtree", "is_prose").agg(F.count("*").alias("n"))
            .where(F.col("n") >= F.when(F.col("is_prose"), prose_pages).otherwise(min_pages)).select("host", "subtree"))


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, prose_pages: int = PROSE_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id``, ``url``, ``html``).

    Null or empty html has an empty text; a null url is a host of its own.  Repeated rows stay repeated.  Time and
    memory of a page are linear in its length, however deep or broken its markup is; other columns are not read.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.col("html").cast("string").alias("html"), F.monotonically_increasing_id().alias("row"))
    parsed = materialize(source.mapInArrow(_read, "page_id long, url string, " + _PARSED), "parsed")
    templates = materialize(site_templates(parsed, min_pages, prose_pages), "templates")
    removed = (parsed.select("row", "host", F.explode("asked").alias("subtree"))
               .join(templates.distinct(), ["host", "subtree"]).groupBy("row").agg(F.collect_list("subtree").alias("removed")))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ("ups", "flags", "digests", "at", "texts")
        for batch in batches:
            columns = {f: batch.column(f) for f in (*fields, "removed")}
            texts = [text_without({f: columns[f][i].as_py() for f in fields}, set(columns["removed"][i].as_py() or ()))
                     for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    columns = ["page_id", "url", "ups", "flags", "digests", "at", "texts", "removed"]
    # pages that no removal could change are not shuffled
    same = parsed.where(F.size("asked") == 0).withColumn("removed", F.lit(None).cast("array<bigint>")).select(*columns)
    other = parsed.where(F.size("asked") > 0).join(removed, "row", "left").select(*columns)
    return same.unionByName(other).mapInArrow(clean, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))


def op10_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text(table(spark, sf_dir, "pages"))
