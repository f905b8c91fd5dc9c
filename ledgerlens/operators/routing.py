"""Routing of statement documents, schema inference from header words, aggregates and line parsers.

Documents are tables of page lines (doc_id, page, line_no, text) and of words (doc_id, page, word_no, text, x0, top, x1, bottom).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import truthy
from ..functions.numbers import MONTHS, as_of_date

# Signals of document classes, titles and header fingerprints of the template families.
LETTER_SIGNALS = ["investor letter", "a note from", "dear limited partners", "letter to investors"]
SCHEDULE_TITLES = ["schedule of investments", "schedule of investment", "schedule of portfolio investments", "combined schedule of portfolio investments", "condensed schedule of investments"]
AGGREGATE_SIGNALS = ["statement of financial condition", "statement of assets", "investments, at fair value"]
AUDIT_SIGNALS = ["independent auditor", "independent auditors", "audited financial statements", "report of independent"]
HEADER_ALIASES = {
    "entity_name": ["company name", "company", "portfolio company", "issuer"],
    "investment_date": ["invt. date", "date"],
    "round": ["round", "series", "security"],
    "shares": ["# shares", "shares (#)", "number of shares", "shares"],
    "cost_per_share": ["cost/share"],
    "fmv_per_share": ["fmv/share", "fair value/share"],
    "cost": ["cost"],
    "fair_value": ["fair value", "fmv", "value"],
    "unrealized_gain_loss": ["unrealized gain (loss)", "net unrealized", "gain/(loss)"],
    "pct_of_capital": ["% of partners' capital", "% of capital"],
}
COUNTRIES = ["france", "netherlands", "norway", "united kingdom", "united states", "bermuda", "sweden", "germany", "canada", "japan", "ireland", "switzerland"]
SECTORS = ["consumer staples", "industrials", "financial", "real estate", "services", "communication services", "information technology", "reinsurance", "software", "health care", "energy", "materials"]
HEADINGS = ["investments", "common stocks", "private investments", "short-term investments", "derivative contracts", "% of", "capital", "number of shares x cost x fair value x capital"]


@dataclass(frozen=True)
class Family:
    name: str
    fingerprints: tuple[str, ...]
    least_hits: int
    realized_titles: tuple[str, ...] = ()
    grain: str = "company"
    needs_audit: bool = False
    bonus: tuple[tuple[str, int], ...] = field(default=())


# The families with what their headers hold.
FAMILIES = [
    Family("audited_portfolio_schedule", ("portfolio investments", "industry", "country", "net unrealized", "shares or principal"), 3, needs_audit=True),
    Family("condensed_hedge_schedule", ("condensed schedule", "% of partners' capital", "number of shares", "fair value"), 2, grain="mixed_condensed"),
    Family("simple_lot_schedule", ("invt. date", "shares (#)", "cost/share", "fair value/share", "unrealized gain (loss)"), 3),
    Family("vc_lot_schedule", ("company name", "cost/share", "fmv/share", "# shares", "round"), 3, realized_titles=("schedule of realized",)),
]


def any_of(text: Column, phrases: list[str]) -> Column:
    return truthy(reduce(or_, [text.contains(p) for p in phrases], F.lit(False)))


def audit_signal(text: Column) -> Column:
    denied = text.contains("unaudited") & ~text.contains("independent auditor") & ~text.contains("report of independent")
    return ~truthy(denied) & any_of(text, AUDIT_SIGNALS)


def pages(lines: DataFrame, most: int = 25) -> DataFrame:
    """(doc_id, page, text, head): lower-cased text of the first pages and its first eight lines."""
    rows = lines.where(F.col("page") <= most).select("doc_id", "page", F.struct("line_no", F.lower("text").alias("t")).alias("l"))
    grouped = rows.groupBy("doc_id", "page").agg(F.transform(F.sort_array(F.collect_list("l")), lambda x: x["t"]).alias("ls"))
    return grouped.select("doc_id", "page", F.array_join("ls", "\n").alias("text"), F.array_join(F.slice("ls", 1, 8), "\n").alias("head"))


def schedule_page(titles: list[str]) -> Column:
    """Whether a page starts a schedule: a title near its top, or anywhere with digits; tables of contents and auditors' pages are none."""
    text, head = F.col("text"), F.col("head")
    skip = text.contains("table of contents") | head.contains("independent auditor") | F.substring(text, 1, 500).contains("we have audited")
    later = any_of(text, titles) & text.rlike(r"\d") & ~head.contains("page(s)")
    return ~truthy(skip) & (any_of(head, titles) | later)


def route(lines: DataFrame, filenames: DataFrame | None = None, words: DataFrame | None = None, least_confidence: float = 0.55) -> DataFrame:
    """(doc_id, document_class, template_family, extraction_mode, schedule_pages, as_of, confidence) of each document.

    filenames is (doc_id, filename), optional. Ties between families go to the alphabetically last. A schedule of no known family is read by
    the header on its pages, if words are given and the header is sure enough and names both amounts; else it is left to review.
    """
    by_page = pages(lines)
    docs = by_page.groupBy("doc_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), "\n").alias("text"),
        F.sort_array(F.collect_list(F.when(schedule_page(SCHEDULE_TITLES), F.col("page")))).alias("schedule_pages"),
    )
    docs = docs.join(filenames, "doc_id", "left") if filenames is not None else docs.withColumn("filename", F.lit(""))
    name, text = F.lower(F.coalesce("filename", F.lit(""))), F.col("text")
    has = F.size("schedule_pages") > 0
    letter = (any_of(text, LETTER_SIGNALS) | any_of(name, LETTER_SIGNALS)) & (~has | name.contains("investor letter"))
    scores = []
    for f in FAMILIES:
        hits = reduce(lambda a, b: a + b, [text.contains(t).cast("int") for t in f.fingerprints])
        extra = {
            "condensed_hedge_schedule": F.when(text.contains("condensed schedule"), 3),
            "simple_lot_schedule": F.when(text.contains("schedule of investment") & ~text.contains("schedule of investments"), 2),
            "vc_lot_schedule": F.when(text.contains("schedule of investments") & text.contains("cost/share"), 2),
            "audited_portfolio_schedule": F.when(audit_signal(text) | name.contains("final -"), 2),
        }[f.name]
        score = hits + F.coalesce(extra, F.lit(0))
        allowed = (audit_signal(text) | name.contains("audited") | name.contains("afs")) if f.needs_audit else F.lit(True)
        scores.append(F.when(allowed & (score >= f.least_hits), F.struct(score.alias("score"), F.lit(f.name).alias("family"))))
    docs = docs.withColumn("best", F.when(has, F.array_max(F.array_compact(F.array(*scores)))))
    docs = docs.withColumn("inferred", F.lit(0.0)).withColumn("readable", F.lit(False))
    if words is not None:
        unmapped = docs.where("best is null").select("doc_id", F.explode("schedule_pages").alias("page"))
        schemas = infer_schema(words.join(unmapped, ["doc_id", "page"])).select("doc_id", F.col("confidence").alias("inferred"), ((F.col("confidence") >= least_confidence) & (F.col("missing") == "")).alias("readable"))
        docs = docs.drop("inferred", "readable").join(schemas, "doc_id", "left").fillna({"inferred": 0.0, "readable": False})
    position, aggregate = has & F.col("best").isNotNull(), any_of(text, AGGREGATE_SIGNALS)
    mode = F.when(letter, "blocked_narrative").when(position, "position_level").when(has & F.col("readable"), "position_level_inferred").when(has, "manual_review").when(aggregate, "fund_aggregate_only").otherwise("manual_review")
    kind = F.when(letter, "investor_letter").when(has, "financial_statements_with_schedule").when(aggregate, "financial_statements_aggregate_only").otherwise("unknown")
    sure = F.when(letter, 0.95).when(position, F.least(F.lit(0.99), 0.55 + 0.1 * F.col("best.score"))).when(has & (F.col("inferred") > 0), F.col("inferred")).when(has, 0.4).when(aggregate, 0.9).otherwise(0.2)
    found = F.when(letter, F.array().cast("array<int>")).otherwise(F.col("schedule_pages"))
    return docs.select("doc_id", kind.alias("document_class"), F.when(position & ~letter, F.col("best.family")).when(F.col("readable") & ~letter, "generic_holdings_schedule").alias("template_family"), mode.alias("extraction_mode"), F.array_join(F.transform(found, lambda p: p.cast("string")), ",").alias("schedule_pages"), as_of_date(text).alias("as_of"), F.round(sure, 3).alias("confidence"))


NEEDED = ["cost", "fair_value"]
WORD = "struct(word_no, lower(text) as t, (x0 + x1) / 2 as mid, cast(x0 as double) as x0, cast(top as double) as top)"


def _joined(ws: Column) -> Column:
    return F.array_join(F.transform(ws, lambda w: w["t"]), " ")


def _opening(ws: Column, joined: Column, alias: str) -> Column:
    """Middle of the first word that may open the alias, if the joined words hold the alias."""
    first = alias.split()[0]
    return F.when(joined.contains(alias), F.get(F.filter(ws, lambda w: (w["t"] == first) | w["t"].startswith(first[:4])), F.lit(0))["mid"])


def _placed(ws: Column, joined: Column, exact: bool) -> Column:
    """(x, name) of the logical columns that the words name, from left to right. exact: words that are an alias by themselves go before."""
    found = []
    for logical, aliases in HEADER_ALIASES.items():
        alone = F.array_min(F.transform(F.filter(ws, lambda w: w["t"].isin(aliases)), lambda w: F.struct(w["x0"], w["mid"])))["mid"]  # noqa: B023
        x = F.coalesce(*([alone] if exact else []), *[_opening(ws, joined, a) for a in aliases])
        found.append(F.when(x.isNotNull(), F.struct(x.alias("x"), F.lit(logical).alias("name"))))
    return F.array_sort(F.array_compact(F.array(*found)))


def headers(words: DataFrame, least: int = 3, soft: int = 2, near: float = 18.0, first_pages: int = 5) -> DataFrame:
    """(doc_id, page, source, c): the header of each document; c is an array of (x, name), its logical columns from left to right.

    The header of a page is its line that names most logical columns, ``least`` at least (of equals the upper one), with other such lines at most
    ``near`` points off. A page without one has a soft header if the words of its upper 35 % name ``soft`` columns. The first of a document's
    ``first_pages`` first pages with a header counts. Nulls in text or places never match. Documents without a header have no row.
    """
    rows = words.where("text is not null and top is not null")
    hit = lambda t: F.array_compact(F.array(*[F.when(reduce(or_, [t.contains(a) for a in aliases]), logical) for logical, aliases in HEADER_ALIASES.items()]))
    lines = rows.groupBy("doc_id", "page", F.bround(F.col("top").cast("double"), 0).alias("y")).agg(F.array_sort(F.collect_list(F.expr(WORD))).alias("ws"))
    lines = lines.withColumn("n", F.size(hit(_joined(F.col("ws"))))).where(F.col("n") >= least)
    bands = lines.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "y", "ws"))).alias("b"))
    band = F.flatten(F.transform(F.filter("b", lambda l: F.abs(l["y"] - F.get("b", F.lit(0))["y"]) <= near), lambda l: l["ws"]))
    bands = bands.select("doc_id", "page", band.alias("ws")).select("doc_id", "page", _placed(F.col("ws"), _joined(F.col("ws")), True).alias("hard"))
    by_page = rows.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.expr(WORD))).alias("ws"), (0.35 * F.max(F.col("top").cast("double"))).alias("edge"))
    upper = by_page.select("doc_id", "page", F.filter("ws", lambda w: w["top"] <= F.col("edge")).alias("ws"))
    upper = upper.select("doc_id", "page", F.when(F.size(hit(_joined(F.col("ws")))) >= soft, _placed(F.col("ws"), _joined(F.col("ws")), False)).alias("soft"))
    both = upper.join(bands, ["doc_id", "page"], "left").select("doc_id", F.struct("page", F.when(F.col("hard").isNotNull(), "header_band").otherwise("upper_part").alias("source"), F.coalesce("hard", "soft").alias("c")).alias("p"))
    first = both.groupBy("doc_id").agg(F.slice(F.array_sort(F.collect_list("p")), 1, first_pages).alias("ps"))
    return first.select("doc_id", F.get(F.filter("ps", lambda p: p["c"].isNotNull()), F.lit(0)).alias("p")).where("p is not null").select("doc_id", "p.*")


def infer_schema(words: DataFrame, least: int = 3) -> DataFrame:
    """(doc_id, page, columns, names, missing, confidence, grain, company_headers, source) from the header of each document, see headers().

    names are the columns as the row classifier takes them: companies may head their rows without a header of their own (company_headers), and
    both amounts are always there. missing are the amounts that the header doesn't name.
    """
    named = headers(words, least).withColumn("n", F.transform("c", lambda x: x["name"]))
    cols = F.col("n")
    has = lambda c: F.array_contains(cols, c)
    amounts = F.arrays_overlap(cols, F.array(*map(F.lit, ["shares", "cost", "fair_value", "cost_per_share", "fmv_per_share"])))
    sure = 0.35 + 0.2 * reduce(lambda a, b: a + b, [has(c).cast("int") for c in NEEDED]) + F.least(F.lit(0.25), 0.05 * F.size(cols)) + F.when(has("entity_name") | amounts, 0.1).otherwise(0.0)
    grain = F.when(has("cost_per_share") | has("fmv_per_share"), "lot").when(has("pct_of_capital"), "condensed").otherwise("company")
    company_headers = ~has("entity_name") & amounts
    plain = F.transform(cols, lambda c: F.when(c == "entity_name", "company_name").when(c == "investment_date", "date").otherwise(c))
    lead = F.when(company_headers, F.array(F.lit("company_name"))).otherwise(F.array().cast("array<string>"))
    missing = F.filter(F.array(*map(F.lit, NEEDED)), lambda c: ~F.array_contains(cols, c))
    return named.select("doc_id", "page", F.array_join(cols, ",").alias("columns"), F.array_join(F.concat(lead, plain, missing), ",").alias("names"), F.array_join(missing, ",").alias("missing"), F.round(F.least(F.lit(0.95), sure), 3).alias("confidence"), grain.alias("grain"), company_headers.alias("company_headers"), "source")


def phrase_boxes(words: DataFrame, phrase: str) -> DataFrame:
    """(doc_id, page, x0, top, x1, bottom) of the first place of a phrase: the box around the words it overlaps in the joined text of a page."""
    order = Window.partitionBy("doc_id", "page").orderBy("word_no")
    at = words.withColumn("start", F.sum(F.length("text") + 1).over(order) - F.length("text") - 1)
    text = at.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("word_no", "text"))), lambda x: x["text"]), " ").alias("t"))
    found = text.withColumn("p", F.instr(F.lower("t"), phrase.lower()) - 1).where("p >= 0").select("doc_id", "page", "p")
    hit = at.join(found, ["doc_id", "page"]).where((F.col("start") < F.col("p") + len(phrase)) & (F.col("start") + F.length("text") > F.col("p")))
    return hit.groupBy("doc_id", "page").agg(F.min("x0").alias("x0"), F.min("top").alias("top"), F.max("x1").alias("x1"), F.max("bottom").alias("bottom"))


def condensed_positions(lines: DataFrame, skip_prefixes: list[str] = ["condensed schedule", "december", "partners", "total"]) -> DataFrame:  # noqa: B006
    """Positions of a condensed schedule, line by line: (doc_id, page, name, shares, cost, fair_value, entity_grain)."""
    text = F.trim(F.regexp_replace("text", r"\s+", " "))
    low = F.lower("t")
    skip = (F.col("t") == "") | reduce(or_, [low.startswith(p) for p in skip_prefixes]) | low.isin(HEADINGS + COUNTRIES + SECTORS)
    security = r"^(.+?)\s+([\d,\s]+)\s+([\d,]+)\s+([\d,]+)\s+([\d.]+)\s*%?\s*$"
    rollup = r"^(.+?)\s+\$\s*([\d,]+)\s+\$\s*([\d,]+)\s+([\d.]+)\s*%?\s*$"
    rows = lines.withColumn("t", text).where(~skip).withColumn("bare", F.translate("t", "$", " "))
    one, two = F.col("bare").rlike(security), F.col("t").rlike(rollup)
    pick = lambda i, j: F.when(one, F.regexp_extract("bare", security, i)).when(two, F.regexp_extract("t", rollup, j))
    digits = lambda c: F.nullif(F.regexp_replace(c, r"\D", ""), F.lit(""))
    name = F.trim(pick(1, 1))
    shares = F.when(one, digits(F.regexp_extract("bare", security, 2)))
    out = rows.where(one | two).select("doc_id", "page", "line_no", name.alias("name"), shares.alias("shares"), digits(pick(3, 2)).alias("cost"), digits(pick(4, 3)).alias("fair_value"), F.when(F.lower(name) == "other", "other_bucket").when(one, "security").otherwise("sector_rollup").alias("entity_grain"))
    return out.where(~F.lower("name").isin(COUNTRIES + SECTORS) & F.col("cost").isNotNull() & F.col("fair_value").isNotNull())


# Words of securities in inferred schedules and what opens lines that are passed over.
SECURITY_PARTS = ["shares", "preferred", "preference", "common", "note", "warrant", "convertible", "safe", "stock", "equity", "token", "tpa", "saft", "interest", "series", "seed", "class", "pre-", "cccps", "ccps", "rcps", "cps", "ordinary"]
PASSED_OVER = ["schedule of", "confidential", "as of ", "shares ", "cost/", "fv/", "fair value", "private investments", "crypto assets", "subtotal ", "total ", "page "]
AMOUNT = r"^(\$?\(?\d{1,3}(,\d{3})+\)?|\$?\(?\d{4,}\)?|\(\d[\d,]*\))$"
PER_SHARE = r"^\d+\.\d{1,4}$"
PLAIN_NAME = r"^[A-Z0-9][A-Za-z0-9 .,&'()/+-]*$"


def line_positions(lines: DataFrame, company_headers: bool = False, has_shares: bool = False, both_amounts: bool = True) -> DataFrame:
    """Company rows of an inferred schedule from its text: (doc_id, page, line_no, name, cost, fair_value).

    A plain name without numbers opens a company. Lines of a security below it are lots; their last amounts add up. The company closes at its
    first line of bare amounts, which is its total, or at a total line after a lot, or where the next one opens; without a printed total the sum of its
    lots is cost and fair value (no row if there are none). Lines with name and amounts outside any open company are companies by themselves
    unless companies head their rows. Amounts are words of four digits or more, grouped thousands, or numbers in parentheses, read
    without sign; numbers with decimals are prices of a share. Of several amounts the last two are cost and fair value, or only the last if
    not both are columns or shares are printed before it. A company's lines from its name on are one window group: no loop over lines.
    """
    rows = lines.withColumn("t", F.trim(F.regexp_replace("text", r"\s+", " "))).where("t <> ''").withColumn("low", F.lower("t"))
    number = lambda w: w.rlike(AMOUNT) | w.rlike(PER_SHARE)
    rows = rows.withColumn("ws", F.split("t", " ")).withColumn("amounts", F.transform(F.filter("ws", lambda w: w.rlike(AMOUNT)), lambda w: F.regexp_replace(w, r"\D", "").cast("decimal(38,0)")))
    first = F.array_position(F.transform("ws", number), F.lit(True)).cast("int")
    name = F.when(first == 0, F.col("t")).otherwise(F.array_join(F.slice("ws", 1, F.greatest(first - 1, F.lit(0))), " "))
    rows = rows.withColumn("numbers", first > 0).withColumn("name", F.regexp_replace(name, r"^[ :$-]+|[ :$-]+$", ""))
    total = F.col("low").startswith("total ") | F.col("low").startswith("subtotal ")
    passed = reduce(or_, [F.col("low").startswith(p) for p in PASSED_OVER]) | F.col("t").rlike(r"^\d+$")
    opens = ~F.col("numbers") & F.col("t").rlike(PLAIN_NAME) & ~any_of(F.col("low"), [*SECURITY_PARTS, "total"])
    kind = F.when(total, "total").when(passed, "skip").when((F.size("amounts") > 0) & (F.col("name") == ""), "amounts").when(opens, "name").when(F.size("amounts") > 0, "lot")
    order = Window.partitionBy("doc_id").orderBy("page", "line_no")
    marked = rows.withColumn("kind", kind).where("kind is not null and kind <> 'skip'").withColumn("g", F.coalesce(F.sum((F.col("kind") == "name").cast("int")).over(order), F.lit(0)))
    inside = Window.partitionBy("doc_id", "g").orderBy("page", "line_no")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    lots_before = F.coalesce(F.sum((F.col("kind") == "lot").cast("int")).over(before), F.lit(0))
    marked = marked.withColumn("closes", (F.col("g") > 0) & ((F.col("kind") == "amounts") | ((F.col("kind") == "total") & (lots_before > 0))))
    marked = marked.withColumn("closed", F.coalesce(F.max("closes").over(before), F.lit(False)) | (F.col("g") == 0))
    last = F.element_at("amounts", -1)
    cost = last if not both_amounts or (company_headers and has_shares) else F.when(F.size("amounts") > 1, F.element_at("amounts", -2)).otherwise(last)
    pair = F.when(F.size("amounts") > 0, F.struct(cost.alias("cost"), last.alias("fair_value")))
    at = F.struct("page", "line_no")
    companies = marked.where("not closed").withColumn("pair", pair).withColumn("last", F.when(F.size("amounts") > 0, last)).groupBy("doc_id", "g").agg(
        F.max(F.when(F.col("kind") == "name", F.col("t"))).alias("name"),
        F.max_by("pair", F.when((F.col("kind") == "amounts") & F.col("closes"), at)).alias("printed"),
        F.sum(F.when(F.col("kind") == "lot", F.col("last"))).alias("lots"),
        F.max(at).alias("at"),
    )
    lots = F.when(F.col("lots") > 0, F.struct(F.col("lots").alias("cost"), F.col("lots").alias("fair_value")))
    found = companies.select("doc_id", "at.page", "at.line_no", "name", F.coalesce("printed", lots).alias("p"))
    if not company_headers:
        alone = marked.where("closed and kind = 'lot'").where(~any_of(F.lower("name"), SECURITY_PARTS))
        found = found.unionByName(alone.select("doc_id", "page", "line_no", "name", pair.alias("p")))
    return found.where("p is not null").select("doc_id", "page", "line_no", "name", F.col("p.cost").cast("decimal(38,6)").alias("cost"), F.col("p.fair_value").cast("decimal(38,6)").alias("fair_value"))


# What opens lines that are no company, words of securities, and what audited schedules name.
SKIPPED = ["schedule of", "company name", "confidential", "unrealized", "investment, at fair value", "asset type", "preferred stock", "page ", "the following", *[f"{m} " for m in MONTHS.split("|")]]
SECURITY_WORDS = ["shares", "preferred", "preference", "common", "note", "warrant", "convertible", "safe", "cost", "fair", "date", "gain", "page", "stock"]
INDUSTRIES = "Cybersecurity|Software|Technology|Healthcare|Financial"
SUBTOTAL = r"^\$?\s*([\d,]+)\s+\$?\s*([\d,]+)\s+\$?\s*([\d,.()-]+)\s*$"


def _digits(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, r"\D", ""), F.lit("")).try_cast("decimal(38,6)")


def text_subtotals(lines: DataFrame, skip: list[str] = SKIPPED) -> DataFrame:
    """Company rows of a schedule with dated lots, from its text: (doc_id, page, line_no, company_name, cost, fair_value).

    A company line (a name, alone or before a date) is active until its subtotal; lots with amounts give a row each and leave it active; a total line
    right after a company line stands for its subtotal. The state is the last company line since the last subtotal: a window, no loop.
    """
    text = F.trim("text")
    low = F.lower("t")
    lot = r"\d{2}/\d{2}/\d{4}\s+[\d,]+\s+\$?\s*([\d,]+)\s+\$?\s*([\d,]+)"
    total = r"(?i)^total\s+\$?\s*([\d,]+)\s+\$?\s*([\d,]+)"
    start = r"^(\D.*?)\s+\d{1,2}/\d{1,2}/\d{4}\s+"
    bare = F.col("t").rlike(r"^[A-Z][A-Za-z0-9 .,&'()-]+$") & ~low.contains("total") & (F.length("t") > 3) & ~any_of(low, SECURITY_WORDS)
    opened = F.trim(F.regexp_extract("t", start, 1))
    dated = F.col("t").rlike(start) & ~any_of(F.lower(opened), ["shares", "preferred", "preference", "common", "note"])
    kind = F.when(reduce(or_, [low.startswith(p) for p in skip]), "skip").when(F.col("t").rlike(total), "total").when(F.col("t").rlike(SUBTOTAL), "subtotal").when(F.col("t").rlike(lot), "lot").when(dated | bare, "name")
    rows = lines.withColumn("t", text).where("t <> ''").withColumn("kind", kind).withColumn("own", F.when(F.col("kind") == "name", F.when(dated, opened).otherwise(F.col("t"))))
    order = Window.partitionBy("doc_id").orderBy("page", "line_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("last_kind", F.last(F.when(F.col("kind").isin("name", "lot"), F.col("kind")), ignorenulls=True).over(before))
    closes = (F.col("kind") == "subtotal") | ((F.col("kind") == "total") & truthy(F.col("last_kind") == "name"))
    rows = rows.withColumn("segment", F.coalesce(F.sum(truthy(closes).cast("int")).over(before), F.lit(0)))
    inside = Window.partitionBy("doc_id", "segment").orderBy("page", "line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("company_name", F.last("own", ignorenulls=True).over(inside)).where(F.col("company_name").isNotNull() & (closes | (F.col("kind") == "lot")))
    at = lambda i: _digits(F.when(F.col("kind") == "total", F.regexp_extract("t", total, i)).when(F.col("kind") == "subtotal", F.regexp_extract("t", SUBTOTAL, i)).otherwise(F.regexp_extract("t", lot, i)))
    return rows.select("doc_id", "page", "line_no", "company_name", at(1).alias("cost"), at(2).alias("fair_value"))


# How countries are printed in audited schedules, and what opens lines that hold no position there.
AUDITED_COUNTRIES = "USA|Israel|UK|United Kingdom|Canada"
AUDITED_SKIPPED = ["combined schedule", "privately held", "investments industry", "net unrealized", "balances carried", "total investments", "both delaware", "december", "security held"]


def audited_positions(lines: DataFrame, skip: list[str] = AUDITED_SKIPPED) -> DataFrame:
    """Company totals of an audited portfolio schedule: (doc_id, company_name, cost, fair_value).

    A line of name, industry and country, and nothing else, opens a company; its first line of bare amounts is the total, else its last line of a
    series, unless the company had a row before. The lines of a company on a page are one group: no company stays open over a page's
    end. skip are beginnings of lines to pass over; a caller may add the fund's own name.
    """
    company = rf"^(.+?)\s+(?:{INDUSTRIES})\s+(?:{AUDITED_COUNTRIES})$"
    series = r"^(?:Series|Ordinary|Simple|Convertible|Preferred|Common).+?\s+[\d,]+\s+\$?\s*([\d,]+)\s+\$?\s*([\d,]+)"
    bare = r"^([\d,]+)\s+([\d,]+)\s+[\d,()-]+\s*$"
    bared = lambda c: F.trim(F.regexp_replace(F.trim(c), r"[\s*]*\*\s*$", ""))
    rows = lines.withColumn("t", bared(F.col("text"))).where("t <> ''").where(~reduce(or_, [F.lower("t").startswith(p) for p in skip])).withColumn("plain", F.translate("t", "$", ""))
    opens = F.col("t").rlike(company)
    group = F.sum(opens.cast("int")).over(Window.partitionBy("doc_id", "page").orderBy("line_no"))
    amounts = lambda c, p: F.when(F.col(c).rlike(p), F.struct(_digits(F.regexp_extract(c, p, 1)).alias("cost"), _digits(F.regexp_extract(c, p, 2)).alias("fv")))
    marked = rows.withColumn("g", group).where("g > 0").withColumn("sub", F.when(~opens, amounts("plain", bare))).withColumn("ser", F.when(~opens, amounts("t", series)))
    name = F.when(opens, bared(F.regexp_extract("t", company, 1)))
    found = marked.groupBy("doc_id", "page", "g").agg(F.max(name).alias("company_name"), F.min_by("sub", F.when(F.col("sub").isNotNull(), F.col("line_no"))).alias("sub"), F.max_by("ser", F.when(F.col("ser").isNotNull(), F.col("line_no"))).alias("ser"))
    best = F.coalesce("sub", "ser")
    first = Window.partitionBy("doc_id", "company_name").orderBy("page", "g")
    kept = found.where(best.isNotNull()).withColumn("r", F.row_number().over(first)).where("sub is not null or r = 1")
    return kept.select("doc_id", "company_name", best["cost"].alias("cost"), best["fv"].alias("fair_value"))


def header_layout(words: DataFrame, least: int = 3) -> DataFrame:
    """(doc_id, page, columns, separators): logical columns of the header from left to right, and the middles between neighbours, see headers()."""
    middles = F.transform(F.slice("c", 2, F.greatest(F.size("c") - 1, F.lit(0))), lambda x, i: (x["x"] + F.get("c", i)["x"]) / 2)
    return headers(words, least).select("doc_id", "page", F.array_join(F.transform("c", lambda x: x["name"]), ",").alias("columns"), F.array_join(F.transform(middles, lambda x: F.round(x, 1).cast("string")), ",").alias("separators"))


def scaled_layout(separators: list[float], width: float, base_width: float = 1070.0) -> list[float]:
    """Separators of a family's page width for a page of another width."""
    return [round(x * width / base_width, 1) for x in separators]


def fund_aggregate(lines: DataFrame, most: int = 6) -> DataFrame:
    """(doc_id, cost, fair_value, unrealized, as_of) of total investments, from the first of the first pages that states both amounts.

    Either on one line, "investments, at (estimated) fair value (cost $ c) $ v", or the value there and "(cost equal to $ c" elsewhere on the page.
    An amount ends with its line.
    """
    head, amount = r"investments?, at (?:estimated\s+)?fair value\s*", r"\$?\s*([0-9][0-9, \t]*)"
    one, value, apart = rf"{head}\(cost[:\s=]*{amount}\)\s*{amount}", head + amount, r"\(cost equal to\s*" + amount
    t = F.col("text")
    both = lambda c, v: F.struct(_digits(c).alias("cost"), _digits(v).alias("fv"))
    pair = F.when(t.rlike(one), both(F.regexp_extract(t, one, 1), F.regexp_extract(t, one, 2))).when(t.rlike(value) & t.rlike(apart), both(F.regexp_extract(t, apart, 1), F.regexp_extract(t, value, 1)))
    found = pages(lines, most).select("doc_id", "page", pair.alias("v"), F.when(F.col("page") == 1, as_of_date(t)).alias("as_of"))
    by_doc = found.groupBy("doc_id").agg(F.min_by("v", F.when(F.col("v").isNotNull(), F.col("page"))).alias("v"), F.max("as_of").alias("as_of"))
    return by_doc.where("v is not null").select("doc_id", F.col("v.cost").alias("cost"), F.col("v.fv").alias("fair_value"), (F.col("v.fv") - F.col("v.cost")).alias("unrealized"), "as_of")


def metadata(lines: DataFrame) -> DataFrame:
    """(doc_id, field, normalized, parse_status): date, audit status, currency symbol; currency and unit are never disclosed in the text."""
    docs = pages(lines).groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "text"))), lambda x: x["text"]), "\n").alias("t"))
    t = F.col("t")
    audited = F.when(audit_signal(t), "audited").when(t.contains("unaudited"), "unaudited")
    values = {"as_of_date": as_of_date(t), "audit_status": audited, "currency_symbol": F.when(t.contains("$"), "$"), "currency": F.lit(None).cast("string"), "unit": F.lit(None).cast("string")}
    status = lambda v: F.when(v.isNotNull(), "ok").otherwise("not_disclosed")
    return docs.select("doc_id", F.explode(F.array(*[F.struct(F.lit(k).alias("field"), v.alias("normalized"), status(v).alias("parse_status")) for k, v in values.items()])).alias("x")).select("doc_id", "x.*")
