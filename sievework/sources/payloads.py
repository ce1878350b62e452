"""Listings out of landed job-board payloads: one schema and one projection for each platform, all in one pass.

A payload table has (source_id, platform, slug, base_url, payload). Every reader returns LISTING columns;
payloads of another shape yield no rows, and ``payload_errors`` names them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.jsonx import job_posting
from sievework.functions.pages import html_to_text
from sievework.functions.rules import fresh_strict_reason, name_reason, relevance_reason
from sievework.functions.dates import days_ago
from sievework.functions.text import canonical_job_url, job_id, location_text, salary_text, strip

LISTING = ["source_id", "platform", "url", "title", "location_raw", "summary", "salary_range"]
MOST = 2000


def _text(html: Column) -> Column:
    """Plain text of HTML; null if there is none."""
    return F.nullif(html_to_text(html, MOST), F.lit(""))


def _listing(rows: DataFrame, url: Column, title: Column, place: Column, summary: Column | None = None, salary: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return rows.select(
        "source_id", "platform", F.coalesce(url, F.lit("")).alias("url"), strip(F.coalesce(title, F.lit(""))).alias("title"),
        F.nullif(place, F.lit("")).alias("location_raw"), (none if summary is None else summary).alias("summary"), (none if salary is None else salary).alias("salary_range"),
    )


#: What a payload's item gives: ``plain`` is a summary in text, ``html`` one in markup.
_ITEMS = "array<struct<url: string, title: string, location_raw: string, plain: string, html: string, salary_range: string>>"


def _item(url: Column, title: Column, place: Column, plain: Column | None = None, html: Column | None = None, salary: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    fields = (F.coalesce(url, F.lit("")), strip(F.coalesce(title, F.lit(""))), F.nullif(place, F.lit("")), plain, html, salary)
    return F.struct(*((none if c is None else c).alias(n) for n, c in zip(("url", "title", "location_raw", "plain", "html", "salary_range"), fields, strict=True)))


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _parsed(schema: str) -> Column:
    return F.from_json("payload", schema)


def _on_top(item: str) -> Column:
    """The array that a payload is; null if it's anything else."""
    return F.when(F.json_array_length("payload").isNotNull(), F.from_json("payload", f"array<{item}>"))


def _greenhouse() -> Column:
    def item(j: Column) -> Column:
        place = F.coalesce(F.try_variant_get(j["location"], "$.name", "string"), F.when(F.schema_of_variant(j["location"]) == "STRING", F.try_variant_get(j["location"], "$", "string")))
        return _item(j["absolute_url"], j["title"], place, html=j["content"])

    return F.transform(_parsed("jobs array<struct<absolute_url: string, title: string, location: variant, content: string>>")["jobs"], item)


def _lever() -> Column:
    def item(j: Column) -> Column:
        plain = F.concat_ws("\n\n", *(_filled(strip(j[c])) for c in ("descriptionPlain", "descriptionBodyPlain")))
        s = [F.coalesce(j["salaryRange"][c], F.lit("")) for c in ("currency", "min", "max", "interval")]
        salary = F.when(j["salaryRange"].isNotNull(), _filled(strip(F.concat(s[0], F.lit(" "), s[1], F.lit(" - "), s[2], F.lit(" "), s[3]))))
        return _item(j["hostedUrl"], j["text"], j["categories"]["location"], _filled(F.left(plain, F.lit(MOST))), salary=salary)

    return F.transform(_on_top("struct<hostedUrl: string, text: string, categories: struct<location: string>, descriptionPlain: string, descriptionBodyPlain: string, salaryRange: struct<min: string, max: string, currency: string, interval: string>>"), item)


def _ashby() -> Column:
    schema = (
        "jobs array<struct<jobUrl: string, title: string, location: string, address: struct<postalAddress: struct<addressLocality: string, addressRegion: string, "
        "addressCountry: string>>, descriptionPlain: string, descriptionHtml: string, shouldDisplayCompensationOnJobPostings: boolean, compensation: struct<compensationTierSummary: string>>>"
    )

    def item(j: Column) -> Column:
        address = j["address"]["postalAddress"]
        place = F.coalesce(_filled(strip(j["location"])), location_text(*(address[c] for c in ("addressLocality", "addressRegion", "addressCountry"))))
        salary = F.when(j["shouldDisplayCompensationOnJobPostings"], _filled(j["compensation"]["compensationTierSummary"]))
        return _item(j["jobUrl"], j["title"], place, _filled(F.left(strip(j["descriptionPlain"]), F.lit(MOST))), j["descriptionHtml"], salary)

    return F.transform(_parsed(schema)["jobs"], item)


def _personio() -> Column:
    def item(j: Column) -> Column:
        return _item(F.concat(F.lit("https://"), F.col("slug"), F.lit(".jobs.personio.com/job/"), j["id"]), j["name"], j["office"])

    return F.transform(_on_top("struct<id: string, name: string, office: string>"), item)


def _breezy() -> Column:
    def item(j: Column) -> Column:
        place = location_text(j["location"]["city"], j["location"]["state"]["name"], j["location"]["country"]["name"])
        return _item(j["url"], j["name"], place, html=j["description"])

    return F.transform(_on_top("struct<url: string, name: string, description: string, location: struct<city: string, state: struct<name: string>, country: struct<name: string>>>"), item)


def _bamboohr() -> Column:
    def item(j: Column) -> Column:
        place = F.when(j["isRemote"], "Remote").otherwise(location_text(j["location"]["city"], j["location"]["state"]))
        return _item(F.concat(F.lit("https://"), F.col("slug"), F.lit(".bamboohr.com/careers/"), j["id"]), j["jobOpeningName"], place)

    return F.transform(_parsed("result array<struct<id: string, jobOpeningName: string, isRemote: boolean, location: struct<city: string, state: string>>>")["result"], item)


def _teamtailor() -> Column:
    address = "struct<addressLocality: string, addressRegion: string, addressCountry: string>"
    feed = _parsed(f"items array<struct<title: string, url: string, content_html: string, _jobposting: struct<jobLocation: array<struct<address: {address}>>>>>")["items"]
    api = _parsed(
        "data array<struct<id: string, attributes: struct<title: string, status: string, body: string>, relationships: struct<location: struct<data: struct<type: string, id: string>>>>>, "
        "included array<struct<type: string, id: string, attributes: struct<city: string, `country-name`: string>>>"
    )

    def of_feed(j: Column) -> Column:
        first = F.try_element_at(j["_jobposting"]["jobLocation"], F.lit(1))["address"]
        return _item(j["url"], j["title"], location_text(first["addressLocality"], first["addressRegion"], first["addressCountry"]), html=j["content_html"])

    def of_api(j: Column) -> Column:
        link = j["relationships"]["location"]["data"]
        own = F.filter(api["included"], lambda i: (i["id"] == link["id"]) & (i["type"] == F.coalesce(link["type"], F.lit("locations"))))
        place = F.array_min(F.transform(own, lambda i: location_text(i["attributes"]["city"], i["attributes"]["country-name"])))
        return _item(F.concat(F.col("base_url"), F.lit("/jobs/"), j["id"]), j["attributes"]["title"], place, html=j["attributes"]["body"])

    keys = F.json_object_keys("payload")
    is_feed = F.array_contains(keys, "items") & ~F.array_contains(keys, "data")
    named = F.filter(feed, lambda j: (F.coalesce(strip(j["title"]), F.lit("")) != "") & (F.coalesce(j["url"], F.lit("")) != ""))
    return F.when(is_feed, F.transform(named, of_feed)).otherwise(F.transform(F.filter(api["data"], lambda j: j["attributes"]["status"] == "open"), of_api))


def _workday() -> Column:
    def item(j: Column) -> Column:
        return _item(F.concat(F.col("base_url"), F.coalesce(j["externalPath"], F.lit(""))), j["title"], j["locationsText"])

    return F.transform(_parsed("jobPostings array<struct<title: string, externalPath: string, locationsText: string>>")["jobPostings"], item)


def _rippling() -> Column:
    def item(j: Column) -> Column:
        first = F.try_element_at(j["locations"], F.lit(1))
        url = F.coalesce(_filled(j["url"]), F.concat(F.lit("https://ats.rippling.com/"), F.nullif("slug", F.lit("")), F.lit("/jobs/"), j["id"]))
        return _item(url, j["name"], F.coalesce(_filled(first["name"]), location_text(first["state"], first["country"])))

    return F.transform(_parsed("items array<struct<id: string, url: string, name: string, locations: array<struct<name: string, state: string, country: string>>>>")["items"], item)


def _phenom() -> Column:
    record = "struct<id: string, applyUrl: string, title: string, locationName: string, city: string, country: string, description: string>"
    p = _parsed(f"status string, data struct<results: array<{record}>, jobs: array<{record}>>")

    def item(j: Column) -> Column:
        url = F.coalesce(_filled(j["applyUrl"]), F.concat(F.regexp_replace("base_url", "/+$", ""), F.lit("/job/"), j["id"]))
        return _item(url, j["title"], F.coalesce(_filled(j["locationName"]), location_text(j["city"], j["country"])), html=j["description"])

    found = F.coalesce(F.when(F.size(p["data"]["results"]) > 0, p["data"]["results"]), p["data"]["jobs"])
    return F.when(p["status"] == "success", F.transform(found, item))


_PLATFORMS = {
    "greenhouse": _greenhouse, "lever": _lever, "ashby": _ashby, "personio": _personio, "breezy": _breezy, "bamboohr": _bamboohr,
    "teamtailor": _teamtailor, "workday": _workday, "rippling": _rippling, "phenom": _phenom,
}
_MARKUP, _ESCAPED, _DETAILED = {"greenhouse", "ashby", "breezy", "teamtailor", "phenom"}, {"greenhouse"}, ["personio", "workday"]


def _listings(payloads: DataFrame, platforms: list[str], details: DataFrame | None = None) -> DataFrame:
    """The listings of these platforms in one pass: a payload is parsed by its platform's schema only, and its items are exploded once."""
    items = F.lit(None).cast(_ITEMS)
    for name in reversed(platforms):
        items = F.when(F.col("platform") == name, _PLATFORMS[name]().cast(_ITEMS)).otherwise(items)
    rows = payloads.filter(F.col("platform").isin(platforms)).select("source_id", "platform", F.explode(items).alias("j"))
    rows, summary = rows.select("source_id", "platform", "j.*"), F.col("plain")
    if _ESCAPED & set(platforms):
        escaped = F.col("platform").isin(*_ESCAPED)
        rows = rows.withColumn("html", F.when(escaped, html_to_text(F.when(escaped, F.col("html")), 1_000_000)).otherwise(F.col("html")))
    if _MARKUP & set(platforms):
        summary = F.coalesce("plain", _text(F.when(F.col("plain").isNull(), F.col("html"))))
    out = rows.withColumn("summary", summary).select(*LISTING)
    return out if details is None else _with_detail(out, details)


def _with_detail(listings: DataFrame, details: DataFrame) -> DataFrame:
    """Listings with the description that the linked data of their landed page (url, html) has, on the platforms that need it.
    Other listings get keys of their own, so that they are spread and meet no page."""
    found = details.groupBy(F.col("url").alias("_at")).agg(F.min("html").alias("html")).select("_at", _text(F.coalesce(job_posting(F.col("html"))["description"], F.lit(""))).alias("detail"))
    own = F.concat(F.lit("\0"), F.xxhash64("source_id", "url", "title").cast("string"))
    keyed = listings.withColumn("_key", F.when(F.col("platform").isin(_DETAILED), F.col("url")).otherwise(own))
    return keyed.join(found, F.col("_key") == F.col("_at"), "left").withColumn("summary", F.coalesce("summary", "detail")).select(*LISTING)


def from_greenhouse(payloads: DataFrame) -> DataFrame:
    """A place is an object with a name, or text; the description's markup comes escaped."""
    return _listings(payloads, ["greenhouse"])


def from_lever(payloads: DataFrame) -> DataFrame:
    """An array on top; anything else is no listing."""
    return _listings(payloads, ["lever"])


def from_ashby(payloads: DataFrame) -> DataFrame:
    """Plain text before HTML; a salary only if it's shown."""
    return _listings(payloads, ["ashby"])


def from_personio(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """S5d: addresses out of slug and id; the description from the detail page."""
    return _listings(payloads, ["personio"], details)


def from_breezy(payloads: DataFrame) -> DataFrame:
    """S5e: city, state and country."""
    return _listings(payloads, ["breezy"])


def from_bamboohr(payloads: DataFrame) -> DataFrame:
    """S5f: remote, or city and state; no description."""
    return _listings(payloads, ["bamboohr"])


def from_teamtailor(payloads: DataFrame) -> DataFrame:
    """S5g: a JSON feed if there are items and no data, or else JSON:API, whose places are among the included records."""
    return _listings(payloads, ["teamtailor"])


def from_workday(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """S5h: a row of the table is a page of results; descriptions come from detail pages."""
    return _listings(payloads, ["workday"], details)


def from_rippling(payloads: DataFrame) -> DataFrame:
    """S5i: the first place's name, or state and country."""
    return _listings(payloads, ["rippling"])


def from_phenom(payloads: DataFrame) -> DataFrame:
    """S5j: results or jobs of successful replies."""
    return _listings(payloads, ["phenom"])


def from_search_items(payloads: DataFrame, search_name: str = "slug", now: Column | None = None, max_days: int = 30, exempt: list = ()) -> DataFrame:
    """S5k: LISTING and ``reason``: why an item is dropped (name, age, relevance), null if it's kept."""
    item = "struct<link: string, jobUrl: string, title: string, companyName: string, postedAt: string, descriptionText: string, descriptionHtml: string, location: string, salaryInfo: struct<currency: string, value: struct<minValue: string, maxValue: string, unitText: string>>>"
    own = payloads.filter(F.col("platform") == "search").withColumn("p", F.from_json("payload", f"array<{item}>"))
    rows = own.select("source_id", "platform", F.col(search_name).alias("search_name"), F.explode("p").alias("j"))
    link = F.coalesce(F.nullif("j.link", F.lit("")), F.nullif("j.jobUrl", F.lit("")))
    rows = rows.withColumn("link", link).filter(F.col("link").isNotNull() & (strip(F.coalesce("j.title", F.lit(""))) != ""))
    age = days_ago(F.col("j.postedAt"), now if now is not None else F.current_timestamp())
    stale = F.when(age > max_days, F.concat(F.lit("stale ("), age.cast("string"), F.lit("d)")))
    reason = F.coalesce(name_reason(F.col("search_name"), F.col("j.companyName"), F.lit(False), "actor"), stale, relevance_reason(F.col("j.title"), F.col("source_id"), exempt))
    s = "j.salaryInfo."
    salary = salary_text(F.col(s + "currency"), F.col(s + "value.minValue"), F.col(s + "value.maxValue"), F.col(s + "value.unitText"))
    summary = F.coalesce(_text(F.nullif("j.descriptionText", F.lit(""))), _text(F.col("j.descriptionHtml")))
    marked = rows.withColumn("reason", reason)
    kept = _listing(marked.withColumn("_r", F.col("reason")), canonical_job_url("link"), F.col("j.title"), F.col("j.location"), summary, salary)
    # of items with one address, one that is kept keeps it
    told = marked.groupBy("source_id", canonical_job_url("link").alias("url")).agg(F.when(~F.bool_or(F.col("reason").isNull()), F.min("reason")).alias("reason"))
    return kept.join(told, ["source_id", "url"], "left").select(*LISTING, "reason")


def from_job_page(pages: DataFrame, now: Column) -> DataFrame:
    """S5l: a landed page's linked data, or else its heading; without a title a parse error. ``reason`` is P10's."""
    p = job_posting(F.col("html"))
    rows = pages.withColumn("p", p)
    title = F.coalesce(F.nullif(strip(F.col("p.title")), F.lit("")), F.nullif(strip(F.regexp_replace(F.regexp_extract("html", "(?is)<h1[^>]*>(.*?)</h1>", 1), "<[^>]+>", "")), F.lit("")))
    age = F.coalesce(days_ago(F.col("p.date_posted"), now, clamp=False), days_ago(F.col("html"), now, posted=True))
    out = rows.select(
        canonical_job_url("url").alias("url"), title.alias("title"), F.col("p.org").alias("hiring_org"), F.col("p.location").alias("location_raw"),
        _text(F.col("p.description")).alias("summary"), salary_text(F.col("p.currency"), F.col("p.salary_min"), F.col("p.salary_max"), F.col("p.salary_unit")).alias("salary_range"),
        age.alias("days_ago"), job_id("url").alias("job_id"),
    )
    return out.withColumn("reason", F.when(F.col("title").isNull(), "parse_error").otherwise(fresh_strict_reason(F.col("days_ago"), F.col("job_id"))))


def normalise_payloads(payloads: DataFrame, details: DataFrame) -> DataFrame:
    """Listings of all platforms, in one pass over the payloads."""
    return _listings(payloads, list(_PLATFORMS), details)


def payload_errors(payloads: DataFrame) -> DataFrame:
    """Payloads that no reader can use, with the reason."""
    bad = F.try_parse_json("payload").isNull()
    shape = F.col("platform").isin("lever", "personio", "breezy") & F.json_array_length("payload").isNull()
    status = (F.col("platform") == "phenom") & (F.coalesce(F.get_json_object("payload", "$.status"), F.lit("")) != "success")
    reason = F.when(bad, "not_json").when(shape, "unexpected_shape").when(status, F.concat(F.lit("status "), F.coalesce(F.get_json_object("payload", "$.status"), F.lit("missing"))))
    return payloads.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select("source_id", "platform", "reason")
