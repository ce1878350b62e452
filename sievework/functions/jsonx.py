"""Functions over JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions.text import strip


def job_posting(html: Column) -> Column:
    """the first JobPosting (or described object) of a page's linked data, as a struct; null if none."""
    scripts = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    get = lambda v, path, kind="string": F.try_variant_get(v, path, kind)
    found = F.filter(F.transform(scripts, F.try_parse_json), lambda v: (get(v, "$['@type']") == "JobPosting") | get(v, "$.description").isNotNull())
    first = F.try_element_at(found, F.lit(1))
    fields = {
        "title": "$.title", "org": "$.hiringOrganization.name", "location": "$.jobLocation.address.addressLocality", "description": "$.description",
        "date_posted": "$.datePosted", "currency": "$.baseSalary.currency", "salary_min": "$.baseSalary.value.minValue",
        "salary_max": "$.baseSalary.value.maxValue", "salary_unit": "$.baseSalary.value.unitText",
    }
    return F.when(F.size(found) > 0, F.struct(*(get(first, path).alias(name) for name, path in fields.items())))


def _parsed(text: Column, schema: str) -> Column:
    return F.when(F.try_parse_json(text).isNotNull(), F.from_json(text, schema))


def plain_reply(reply: Column) -> Column:
    """A reply without code fences."""
    return strip(F.regexp_replace(F.regexp_replace(strip(reply), r"^```(?:json)?\s*", ""), r"\s*```\s*$", ""))


def repair_json(reply: Column, schema: str) -> Column:
    """a reply parsed as it is, or else its outermost brackets; null if neither parses."""
    plain = plain_reply(reply)
    opening, closing = ("[", "]") if schema.lower().startswith("array") else ("{", "}")
    start, end = F.instr(plain, opening), F.length(plain) - F.instr(F.reverse(plain), closing) + 1
    return F.coalesce(_parsed(plain, schema), F.when((start > 0) & (end > start), _parsed(F.substring(plain, start, end - start + 1), schema)))


def has_fields(json: Column, fields: list[str]) -> Column:
    """F32: every field is a key of the object."""
    keys = F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))
    return F.size(F.array_except(F.array(*(F.lit(f) for f in fields)), keys)) == 0


def classification_record(rules: Column, reply: Column, now: Column) -> Column:
    """the record that is stored with a job."""
    return F.struct(
        reply.alias("reply"), rules["flags"].alias("rules"), rules["geo_check"].alias("geo_check"), now.alias("classified_at"),
        F.when(reply.isNotNull(), "scorer").otherwise("rules").alias("model"),
    )


def embedded_picks(notes: Column) -> Column:
    """the array after PICKS_JSON: in a note."""
    text = F.regexp_extract(notes, r"(?s)PICKS_JSON:\s*(\[.*\])", 1)
    return F.when(text != "", F.from_json(text, "array<struct<company: string, slug: string, news_url: string>>"))


def valid_response(platform: Column, json: Column) -> Column:
    """the reply has the shape of the platform's."""
    array = F.json_array_length(json).isNotNull()
    keys = F.coalesce(F.json_object_keys(json), F.array().cast("array<string>"))
    has = lambda *names: F.arrays_overlap(keys, F.array(*(F.lit(n) for n in names)))
    by_platform = (
        F.when(platform == "greenhouse", has("jobs"))
        .when(platform == "workable", has("results", "jobs"))
        .when(platform == "ashby", has("jobPostings", "jobs", "results"))
        .when(platform == "smartrecruiters", F.coalesce(F.get_json_object(json, "$.totalFound").try_cast("int") > 0, F.lit(False)))
        .when(platform == "teamtailor", has("data", "jobs"))
        .otherwise(True)
    )
    return F.when(array, True).when(F.json_object_keys(json).isNull(), False).otherwise(by_platform)
