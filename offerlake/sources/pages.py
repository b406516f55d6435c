"""Listing pages: extraction specs, assembly into landing rows, and fixture rendering.

``detail_fields``/``listing_cards`` turn pages into columns with one parse per page
(``operators.html_extract``); ``assemble_listings`` joins cards to their detail pages
on the job URL (an equi left join: cards without a detail page keep NULL details).
The ``render_*`` functions build ``data-test`` pages from derived listings with plain
string expressions, giving the extractors real input at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import after_first_colon
from ..functions.ids import SITE_ROOT, absolute_url, listing_id
from ..operators.html_extract import Field, Records, Sel, extract
from ..schemas import LANDING_COLUMNS, LIST_COLUMNS
from .landing import TECH_SEPARATOR, TEXT_LIST_SEPARATOR, flatten_lists


def _dt(tag: str, value: str) -> Sel:
    return Sel(tag, "data-test", value)


# Data-test hooks of a listing detail page.
DETAIL_SPECS = (
    Field("expiration_text", (_dt("span", "text-expirationDate"),)),
    Field("posting_text", (_dt("span", "text-fromDate"),)),
    Field("job_level", (_dt("span", "content-positionLevels"),)),
    Field("contract_type", (_dt("span", "text-contractName"),)),
    Field("remuneration", (_dt("span", "text-contractSalary"),)),
    Field("gross_or_net_text", (_dt("span", "text-contractUnits"),)),
    Field("frequency_text", (_dt("span", "text-contractTimeUnits"),)),
    Field("technologies", (_dt("div", "section-technologies"), _dt("div", "chip-technology")),
          many=True, prefer_attr="title"),
    Field("address_1", (_dt("span", "text-currentLocation1"),)),
    Field("address_2", (_dt("span", "text-currentLocation2"),)),
    Field("requirement_items", (_dt("div", "section-requirements"), _dt("ul", "section-requirements-expected"),
                                Sel("li", "class", "lxul5ps")), many=True),
    Field("responsibility_items", (_dt("div", "section-responsibilities"), Sel("li", "class", "lxul5ps")),
          many=True),
)

# Data-test hooks of a listing card on a search-result page.
CARD_SPEC = Records(
    "cards",
    item=_dt("a", "list-item-offer"),
    body=Sel("div", "class", "p17ye701"),
    own=(Field("href", (), attr="href"),),
    fields=(
        Field("job_title", (_dt("h2", "text-jobTitle"),)),
        Field("company_name", (_dt("div", "text-employerName"),)),
        Field("location", (_dt("div", "text-workplaces"),)),
        Field("work_mode", (_dt("div", "text-workModes"),)),
    ),
)

# Generic page fields (no data-test hooks needed).
GENERIC_SPECS = (
    Field("title", (Sel("title"),)),
    Field("heading", (Sel("h1"),)),
    Field("ad_text", (Sel("div", "class", "ad"),)),
    Field("footer_text", (Sel("footer"),)),
    Field("article_text", (Sel("article"),)),
    Field("nav_links", (Sel("nav"), Sel("li")), many=True),
)


def detail_fields(details: DataFrame, key: str = "job_url", html_col: str = "html",
                  partitions: int | None = None) -> DataFrame:
    """Detail pages (key, html) -> one row of raw listing fields per page.

    Dates keep the text after the first colon; the salary span gates its two
    companions (no salary element -> all three NULL)."""
    ex = extract(details, DETAIL_SPECS, html_col=html_col, keep=[key], partitions=partitions)
    gate = F.col("remuneration").isNotNull()
    return ex.select(
        key,
        after_first_colon("expiration_text").alias("expiration_date"),
        after_first_colon("posting_text").alias("job_posting_date"),
        "job_level", "contract_type", "remuneration",
        F.when(gate, F.col("frequency_text")).alias("frequency"),
        F.when(gate, F.col("gross_or_net_text")).alias("gross_or_net"),
        F.col("technologies").alias("expected_technologies"),
        "address_1", "address_2",
        F.col("requirement_items").alias("requirements"),
        F.col("responsibility_items").alias("responsibilities"),
    )


def listing_cards(list_pages: DataFrame, html_col: str = "html", site_root: str = SITE_ROOT,
                  partitions: int | None = None) -> DataFrame:
    """Search-result pages -> one row per card (job_url absolute, listing id, card fields)."""
    ex = extract(list_pages, (CARD_SPEC,), html_col=html_col, keep=[], partitions=partitions)
    cards = ex.select(F.explode("cards").alias("c")).select("c.*")
    url = absolute_url(F.col("href"), site_root)
    return cards.select(
        listing_id(url).alias("job_listing_id"),
        url.alias("job_url"),
        "job_title", "company_name", "location", "work_mode",
    )


def assemble_records(cards: DataFrame, details: DataFrame, ingestion_timestamp: str,
                     ingestion_date: str) -> DataFrame:
    """Cards left-joined to their details on job_url -> the 20 landing columns, lists as
    arrays ([] where there is none), one run stamp for every row.

    Both sides are keyed by the listing URL; the planner shuffles both on it (or
    broadcasts a side whose size it knows is small); a card whose detail page is missing
    keeps NULL scalars and empty lists.  Cards with a NULL URL are kept with NULLs: each gets
    a key of its own, so they match nothing and do not meet in one task.  A URL crawled more
    than once gives one detail row (the greatest by field order, chosen by pre-aggregation),
    so cards are never multiplied; repeated cards stay repeated.  Each side is read once."""
    fields = [c for c in details.columns if c != "job_url"]
    one = (details.where(F.col("job_url").isNotNull()).groupBy(F.col("job_url").alias("__url"))
           .agg(F.max(F.struct(*fields)).alias("d")).select("__url", "d.*"))
    own = F.concat(F.lit("\0"), F.monotonically_increasing_id().cast("string"))
    joined = cards.withColumn("__url", F.coalesce("job_url", own)).join(one, "__url", "left")
    stamp = {"ingestion_timestamp": ingestion_timestamp, "ingestion_date": ingestion_date}

    def landing_column(name: str) -> Column:
        if name in LIST_COLUMNS:
            return F.coalesce(F.col(name), F.array().cast("array<string>")).alias(name)
        if name in stamp:
            return F.lit(stamp[name]).alias(name)
        return F.col(name)

    return joined.select(*[landing_column(c) for c in LANDING_COLUMNS])


def assemble_listings(cards: DataFrame, details: DataFrame, ingestion_timestamp: str, ingestion_date: str) -> DataFrame:
    """:func:`assemble_records` with its lists flattened ('' for an empty list)."""
    return flatten_lists(assemble_records(cards, details, ingestion_timestamp, ingestion_date))


def generic_fields(pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """Title, heading, ad, footer, article text and navigation links of each page."""
    return extract(pages, GENERIC_SPECS, html_col="html", keep=["page_id", "url"], partitions=partitions)


# ---------------------------------------------------------------------------
# Fixture rendering: data-test pages built from listing rows with string expressions.
# ---------------------------------------------------------------------------

def html_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                               F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def _el(tag: str, hook: str, value: Column, pad: str = "") -> Column:
    """``<tag data-test=hook>value</tag>`` or '' when value is NULL."""
    return F.coalesce(F.concat(F.lit(f'<{tag} data-test="{hook}">{pad}'), html_escape(value),
                               F.lit(f"{pad}</{tag}>")), F.lit(""))


def _items(values: Column, sep: str, open_tag: Column, close_tag: Column) -> Column:
    """Wrap every item of a separator-joined string in open/close markup (one string
    replace, no lambda); '' when NULL."""
    escaped = html_escape(values)
    inner = F.replace(escaped, F.lit(sep), F.concat(close_tag, open_tag))
    return F.coalesce(F.concat(open_tag, inner, close_tag), F.lit(""))


def render_detail_page(k: Column) -> Column:
    """A detail page for the listing row in scope (columns of the landing shape)."""
    by_title = k % 2 == 0  # technology named by the title attribute, else by the chip text
    chip_open = F.when(by_title, F.lit('<div data-test="chip-technology" title="')) \
        .otherwise(F.lit('<div data-test="chip-technology" title=""><span> '))
    chip_close = F.when(by_title, F.lit('"><img src="x.svg"></div>')).otherwise(F.lit(" </span></div>"))
    li_open, li_close = F.lit('<li class="lxul5ps x1">'), F.lit("</li>")

    salary = F.when(
        F.col("remuneration").isNotNull(),
        F.concat(_el("span", "text-contractSalary", F.col("remuneration")),
                 _el("span", "text-contractUnits", F.col("gross_or_net")),
                 _el("span", "text-contractTimeUnits", F.col("frequency"))),
    ).otherwise(F.lit('<span data-test="text-contractTimeUnits">mth</span>'))
    return F.concat(
        F.lit('<!DOCTYPE html><html><head><title>Oferta</title><script>var x = "</span>";</script></head><body>'),
        F.lit('<div data-test="section-workplace">'),
        _el("span", "text-currentLocation1", F.col("address_1"), "  "),
        _el("span", "text-currentLocation2", F.col("address_2")),
        F.lit("</div><p><!-- offer meta -->"),
        F.coalesce(F.concat(F.lit('<span data-test="text-expirationDate">Ważna do: <b>'),
                            html_escape(F.col("expiration_date")), F.lit("</b></span>")), F.lit("")),
        F.coalesce(F.concat(F.lit('<span data-test="text-fromDate">Opublikowana:'),
                            html_escape(F.col("job_posting_date")), F.lit("</span>")), F.lit("")),
        F.lit("<br>"),
        _el("span", "content-positionLevels", F.col("job_level"), "  "),
        _el("span", "text-contractName", F.col("contract_type")),
        salary,
        F.lit('<div data-test="section-technologies">'),
        _items(F.col("expected_technologies"), TECH_SEPARATOR, chip_open, chip_close),
        F.lit('</div><div data-test="section-requirements"><ul data-test="section-requirements-expected">'),
        _items(F.col("requirements"), TEXT_LIST_SEPARATOR, li_open, li_close),
        F.lit('</ul><ul data-test="section-requirements-optional"><li class="lxul5ps">Nice to have</li></ul></div>'),
        F.lit('<div data-test="section-responsibilities"><ul>'),
        _items(F.col("responsibilities"), TEXT_LIST_SEPARATOR, li_open, li_close),
        F.lit("</ul></div></body></html>"),
    )


def render_card(k: Column) -> Column:
    """One search-result card; relative href on k % 4 == 1.  On k % 53 == 0 a promoted
    duplicate card without a card body precedes it (such cards are skipped)."""
    href = F.when(k % 4 == 1, F.replace(F.col("job_url"), F.lit(SITE_ROOT), F.lit(""))).otherwise(F.col("job_url"))
    body = F.concat(
        F.lit('<div class="p17ye701 c2">'),
        _el("h2", "text-jobTitle", F.col("job_title")),
        _el("div", "text-employerName", F.col("company_name")),
        _el("div", "text-workplaces", F.col("location")),
        _el("div", "text-workModes", F.col("work_mode")),
        F.lit("</div>"),
    )
    promoted = F.when(k % 53 == 0, F.concat(
        F.lit('<a data-test="list-item-offer" href="'), html_escape(href),
        F.lit('"><div class="other">Promoted</div></a>'))).otherwise(F.lit(""))
    return F.concat(promoted, F.lit('<a data-test="list-item-offer" href="'), html_escape(href), F.lit('">'),
                    body, F.lit("</a>"))


def render_fixture_pages(listings: DataFrame, key: Column, cards_per_page: int = 20):
    """(list_pages, detail_pages) from landing-shaped listings.

    Cards are grouped ``cards_per_page`` to a page by key (keys are unique, so each
    page holds at most that many cards: a proven bound per group); listings with
    k % 59 == 0 get an error page without any listing fields."""
    keyed = listings.withColumn("__k", key)
    k = F.col("__k")
    list_pages = (keyed.groupBy(F.floor(k / cards_per_page).alias("page_no"))
                  .agg(F.concat(F.lit("<html><body><main>"),
                                F.array_join(F.collect_list(render_card(k)), ""),
                                F.lit("</main></body></html>")).alias("html")))
    error_page = F.lit("<html><body><h1>Oferta wygasła</h1><p>Offer expired</p></body></html>")
    details = keyed.select("job_url", F.when(k % 59 == 0, error_page)
                           .otherwise(render_detail_page(k)).alias("html"))
    return list_pages, details
