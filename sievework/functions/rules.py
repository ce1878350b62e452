"""Predicates, verdicts and scores over Columns."""

from __future__ import annotations

import re
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import wordlists as W
from sievework.functions.text import col, host, names_match, norm_company, strip, subdomain


def contains_any(c: Column | str, terms: list[str]) -> Column:
    """Any term is in the text, case folded. One pattern, however many terms; no terms are in no text."""
    if not terms:
        return F.lit(False)
    return F.lower(F.coalesce(col(c), F.lit(""))).rlike("|".join(re.escape(t.lower()) for t in terms))


def count_terms(c: Column, terms: list[str]) -> Column:
    """How many of the terms are in the text."""
    text = F.lower(F.coalesce(c, F.lit("")))
    return F.size(F.filter(F.array(*(F.lit(t) for t in terms)), lambda t: F.contains(text, t)))


def matches_word(c: Column | str, words: list[str] | None = None) -> Column:
    """P5: any of the words at word boundaries."""
    return F.coalesce(col(c), F.lit("")).rlike(r"(?i)\b(" + "|".join(re.escape(w) for w in words or W.JUNIOR_WORDS) + r")\b")


def relevance_reason(title: Column | str, source_id: Column | str, exempt: list = ()) -> Column:
    """Why a title is noise; null if it isn't, or if its source is exempt."""
    found = F.lower(F.regexp_extract(F.coalesce(col(title), F.lit("")), r"(?i)\b(" + "|".join(W.NOISE_TITLES) + r")\b", 1))
    hit = found != ""
    if exempt:
        hit = hit & ~F.coalesce(col(source_id).isin(*exempt), F.lit(False))
    return F.when(hit, F.concat(F.lit("relevance_noise ("), found, F.lit(")")))


_N_PLACES = r"(?i)\b\d+ locations?\b"


def geo_verdict(location: Column | str) -> Column:
    """Pass, reject or pending."""
    loc = col(location)
    return (
        F.when(loc.isNull() | (loc == ""), "pending")
        .when(contains_any(loc, W.ELIGIBLE), "pass")
        .when(loc.rlike(_N_PLACES) | contains_any(loc, W.MANY_PLACES_REJECT), "reject")
        .when(contains_any(loc, W.MANY_PLACES_PENDING), "pending")
        .when(contains_any(loc, W.REJECTED), "reject")
        .otherwise("pending")
    )


def geo_verdict_wide(location: Column | str, url: Column | str) -> Column:
    """The same for companies with a wider list; ambiguous places are looked up in the address."""
    loc = col(location)
    office = F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(col(url), F.lit("")), "/job/([^/]+)/", 1)), "-+", " ")
    by_office = (
        F.when(office == "", "pending")
        .when(contains_any(office, W.OFFICE_ELIGIBLE) | contains_any(office, W.OFFICE_BRITAIN), "pass")
        .when(contains_any(office, W.OFFICE_REJECTED), "reject")
        .otherwise("pending")
    )
    return (
        F.when(loc.isNull() | (loc == ""), "pending")
        .when(contains_any(loc, W.ELIGIBLE_WIDE), "pass")
        .when(loc.rlike(_N_PLACES) | contains_any(loc, W.MANY_PLACES_PENDING), by_office)
        .when(contains_any(loc, W.REJECTED_WIDE), "reject")
        .otherwise("pending")
    )


def fresh_strict_reason(days: Column, job: Column, max_days: int = W.MAX_DAYS, floor: int = W.ID_FLOOR) -> Column:
    """P10: why a listing counts as stale; null if it's fresh."""
    return (
        F.when(days > max_days, F.concat(F.lit("posted_too_old ("), days.cast("string"), F.lit("d)")))
        .when(days.isNull() & job.isNull(), "posted_age_unknown")
        .when(days.isNull() & (job < floor), F.concat(F.lit("stale_id ("), job.cast("string"), F.lit(")")))
    )


def name_reason(search: Column, org: Column, override: Column, mode: str = "page") -> Column:
    """Why a company's name doesn't fit; null if it does. In mode page an override passes any name."""
    a, b = norm_company(search), norm_company(org)
    wrong = F.concat(F.lit("name_mismatch ('"), a, F.lit("' != '"), b, F.lit("')"))
    blank = F.coalesce(strip(org), F.lit("")) == ""
    passes = names_match(a, b) | (F.coalesce(override, F.lit(False)) if mode == "page" else F.lit(False))
    return F.when(blank, "no_hiring_org").when(~passes, wrong)


def subdomain_reason(url: Column | str, own: Column) -> Column:
    """Why a sub-domain isn't allowed; null if it is."""
    sub = subdomain(url)
    fine = (sub == "ie") | ((sub == "www") & F.coalesce(own, F.lit(False)))
    return F.when(~fine, F.concat(F.lit("wrong_subdomain ("), sub, F.lit(".linkedin.com)")))


def url_allowed(url: Column | str, allow: str | None = None, block: str | None = None) -> Column:
    """The address matches the allowed pattern and not the blocked one."""
    fine = F.lit(True)
    if allow:
        fine = fine & col(url).rlike(allow)
    if block:
        fine = fine & ~col(url).rlike(block)
    return F.coalesce(fine, F.lit(False))


def usable_page(final_url: Column | str) -> Column:
    """Neither a login page nor a home page."""
    path = F.regexp_extract(col(final_url), "^[a-zA-Z]+://[^/?#]*([^?#]*)", 1)
    path = F.when(path == "", "/").otherwise(path)
    return ~(path.rlike("(?:" + "|".join(W.LOGIN_ENDS) + ")$") | path.isin(*W.HOME_PATHS))


def location_ok(location: Column | str, include: list[str], exclude: list[str], blank_ok: bool = True, order: str = "exclude_first") -> Column:
    """A place that is included and not excluded. ``include_only`` skips the exclusion."""
    loc = F.lower(F.coalesce(col(location), F.lit("")))
    blank = loc.isin("", "nan", "none")
    fine = contains_any(loc, include) if order == "include_only" else contains_any(loc, include) & ~contains_any(loc, exclude)
    return F.when(blank, F.lit(blank_ok)).otherwise(fine)


def valid_http_url(url: Column | str) -> Column:
    """Http or https, with a host."""
    return F.coalesce(col(url).rlike("(?i)^https?://") & (host(url) != ""), F.lit(False))


def rule_chain(title: Column, location: Column, url: Column, is_fdi: Column, founded_here: Column, allowlisted: Column) -> Column:
    """P20: the first rule that rejects, as (rejected, reason, flags, geo_check)."""
    junior = matches_word(title)
    checked = ~junior & F.coalesce(is_fdi, F.lit(False)) & ~F.coalesce(founded_here, F.lit(False))
    geo = F.when(checked, F.when(F.coalesce(allowlisted, F.lit(False)), geo_verdict_wide(location, url)).otherwise(geo_verdict(location))).otherwise("n/a")
    far = geo == "reject"
    flags = F.struct(junior.alias("junior_reject"), far.alias("fdi_geography_reject"), F.lit(False).alias("not_relevant_reject"))
    reason = F.when(junior, "too_junior").when(far, "fdi_geography")
    return F.struct((junior | far).alias("rejected"), reason.alias("reason"), flags.alias("flags"), geo.alias("geo_check"))


def norm_enum(c: Column | str, mapping: dict[str, str]) -> Column:
    """the stored spelling of a value, or null."""
    table = F.create_map(*(F.lit(x) for x in chain(*mapping.items())))
    return F.try_element_at(table, F.lower(strip(c)))


def norm_function(c: Column | str) -> Column:
    """one of the closed list, a trailing parenthesis aside; or null."""
    plain = strip(F.regexp_replace(strip(c), r"\s*\([^)]*\)\s*$", ""))
    return F.when(plain.isin(*W.FUNCTIONS), plain)


def relevance_score(title: Column, summary: Column, company: Column, source: Column, core: list[str], sports: list[str], main_board: str = "LinkedIn") -> Column:
    """the sum of the weights."""
    one = lambda hit, n: F.when(hit, n).otherwise(0)
    is_core = contains_any(company, core)
    return (
        one(is_core, 8) + one(contains_any(title, W.SCORE_STRONG), 10) + one(contains_any(summary, W.SCORE_STRONG), 5)
        + 2 * count_terms(title, W.SCORE_KEYWORDS) + count_terms(summary, W.SCORE_KEYWORDS)
        - one(contains_any(title, W.SCORE_EXCLUDED), 5) - one(contains_any(title, W.SCORE_UNRELATED), 5)
        + one(contains_any(company, sports) & ~is_core, 1) + one(F.coalesce(source, F.lit("")) != main_board, 5)
    ).cast("bigint")


def relevance_band(score: Column) -> Column:
    """high from 10, medium from 5, low above 0; null otherwise."""
    return F.when(score >= 10, "high").when(score >= 5, "medium").when(score > 0, "low")


def scrapability(text: Column | str) -> Column:
    """medium if a page has three signs of listings, or else hard."""
    return F.when(count_terms(col(text), W.CAREER_SIGNS) >= 3, "medium").otherwise("hard")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
