"""Text and address functions: each builds a Column from Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievework.functions import wordlists as W


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def norm_key(c: Column | str) -> Column:
    """lower case, runs of white space as one space; null is empty."""
    return F.regexp_replace(strip(F.lower(F.coalesce(col(c), F.lit("")))), r"(?U)\s+", " ")


def norm_place(c: Column | str) -> Column:
    """F1 for places: blank is null."""
    return F.nullif(norm_key(c), F.lit(""))


def strip_tags(c: Column | str) -> Column:
    """tags out, ends trimmed."""
    return strip(F.regexp_replace(F.coalesce(col(c), F.lit("")), "<[^>]+>", ""))


def choose_title(feed: Column | str, og: Column | str) -> Column:
    """the page's own title if it differs and has 15 characters or more."""
    feed, og = col(feed), col(og)
    return F.when(og.isNotNull() & (og != feed) & (F.length(og) >= 15), og).otherwise(feed)


def norm_company(c: Column | str) -> Column:
    """a company's name without case, trailing parenthesis, one legal suffix and closing punctuation."""
    base = strip(F.regexp_replace(norm_key(c), r"\s*\([^)]*\)\s*$", ""))
    ends = "|".join(s.replace(".", r"\.") for s in sorted(W.LEGAL_SUFFIXES, key=len, reverse=True))
    return strip(F.regexp_replace(F.rtrim(F.regexp_replace(base, f"(?:{ends})$", "")), "[.,;:]+$", ""))


def names_match(a: Column, b: Column) -> Column:
    """equal, or equal but for one closing s."""
    cut = [F.regexp_replace(x, "s$", "") for x in (a, b)]
    return (a == b) | ((cut[0] == cut[1]) & (cut[0] != ""))


def clip(c: Column | str, n: int, ellipsis: str = "") -> Column:
    """F8: at most n characters, the ellipsis included."""
    c = col(c)
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n - len(ellipsis))), F.lit(ellipsis))).otherwise(c)


def host(url: Column | str) -> Column:
    """The host in lower case without ``www.``; empty if there is none."""
    found = F.lower(F.regexp_extract(F.coalesce(col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(found, r"^www\.", "")


def title_case(c: Column) -> Column:
    """Capitals after anything that isn't a letter."""
    return F.array_join(F.transform(F.regexp_extract_all(F.lower(c), F.lit("([a-z]+|[^a-z]+)"), F.lit(1)), F.initcap), "")


def publisher_stem(url: Column | str) -> Column:
    """a publisher's name out of a host: top-level domain off, hyphens as spaces, title case."""
    h = host(url)
    multi = "|".join(t.replace(".", r"\.") for t in W.MULTI_TLDS)
    stem = F.when(h.rlike(f"(?:{multi})$"), F.regexp_replace(h, f"(?:{multi})$", "")).otherwise(F.regexp_replace(h, r"\.[^.]*$", ""))
    return title_case(F.replace(stem, F.lit("-"), F.lit(" ")))


def domain(url: Column | str) -> Column:
    """what stands between the scheme and the next slash, without ``www.``; the address itself if it has no scheme."""
    found = F.regexp_extract(col(url), r"https?://(?:www\.)?([^/]+)", 1)
    return F.when(found != "", found).otherwise(col(url))


def feed_label(url: Column | str, feed_type: Column | str) -> Column:
    """the query of a news search, or else the domain."""
    query = F.regexp_extract(col(url), "[?&]q=([^&]+)", 1)
    news = F.when(query != "", F.concat(F.lit("GNews: "), F.replace(query, F.lit("+"), F.lit(" ")))).otherwise("Google News")
    return F.when(col(feed_type) == "google_news", news).otherwise(domain(url))


_VIEW = r"(?i)^https?://(?:[a-z]{2,3}\.)?linkedin\.com/jobs/view/([^/?#]+)"


def canonical_job_url(url: Column | str) -> Column:
    """one form of a job page's address."""
    slug = F.regexp_extract(col(url), _VIEW, 1)
    other = F.concat(F.regexp_replace(F.regexp_replace(col(url), r"\?.*$", ""), "/+$", ""), F.lit("/"))
    return F.when(slug != "", F.concat(F.lit("https://www.linkedin.com/jobs/view/"), slug, F.lit("/"))).otherwise(other)


def subdomain(url: Column | str) -> Column:
    """the sub-domain of a job page; ``www`` if there is none."""
    found = F.lower(F.regexp_extract(col(url), r"(?i)^https?://([^.]+)\.linkedin\.com/", 1))
    return F.when(found != "", found).otherwise("www")


def job_id(url: Column | str) -> Column:
    """the number that closes an address's last part, query and fragment aside."""
    bare = F.regexp_replace(F.regexp_replace(col(url), "[?#].*$", ""), "/+$", "")
    return F.nullif(F.regexp_extract(F.regexp_extract(bare, "([^/]*)$", 1), r"(\d+)$", 1), F.lit("")).try_cast("bigint")


def strip_tracking(url: Column | str) -> Column:
    """an address without tracking parameters; its fragment stays."""
    url = col(url)
    before, query, fragment = (F.regexp_extract(url, r"^([^?#]*)(?:\?([^#]*))?(#.*)?$", k) for k in (1, 2, 3))
    name = lambda p: F.split_part(p, F.lit("="), F.lit(1))
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~name(p).isin(*W.TRACKING) & ~name(p).startswith("utm_"))
    joined = F.array_join(kept, "&")
    return F.when(query == "", url).otherwise(F.concat(before, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(""), fragment))


def absolute_url(href: Column | str, base: Column | str) -> Column:
    """an address seen from a page: with scheme, with host, from the root, or beside the page. Dot segments
    of a path without a host are resolved, and none leads above the root."""
    href, base = strip(href), col(base)
    scheme = F.regexp_extract(base, "^([a-zA-Z]+:)", 1)
    root = F.regexp_extract(base, "^([a-zA-Z]+://[^/?#]+)", 1)
    folder = F.regexp_extract(F.regexp_replace(base, "[?#].*$", ""), "^([a-zA-Z]+://[^/]+(?:/.*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(root, F.lit("/")))
    return (
        F.when(href == "", base)
        .when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(root, _without_dots(href)))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .when(href.startswith("?"), F.concat(F.regexp_replace(base, "[?#].*$", ""), href))
        .otherwise(F.concat(root, _without_dots(F.concat(F.substring(folder, F.length(root) + 1, F.length(folder)), href))))
    )


def _without_dots(path: Column) -> Column:
    """A path from the root, with query and fragment, without dot segments."""
    own, rest = F.regexp_extract(path, "^([^?#]*)", 1), F.regexp_extract(path, "^[^?#]*(.*)$", 1)
    parts = F.split(F.substring(own, 2, 1 << 30), "/")
    empty = F.array().cast("array<string>")
    kept = F.aggregate(
        parts, empty,
        lambda done, x: F.when(x == ".", done).when(x == "..", F.when(F.size(done) > 0, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(empty)).otherwise(F.concat(done, F.array(x))),
    )
    end = F.when(own.rlike(r"/\.\.?$") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(own.rlike(r"/\.\.?(?:/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"), end, rest)).otherwise(path)


def slug_variants(name: Column | str, website: Column | str) -> Column:
    """slugs to try, most likely first."""
    low, root = F.lower(F.coalesce(col(name), F.lit(""))), F.split_part(host(website), F.lit("."), F.lit(1))
    forms = F.array(
        F.regexp_replace(low, "[^a-z0-9]", ""), F.regexp_replace(F.regexp_replace(low, "[^a-z0-9]+", "-"), "^-+|-+$", ""), root, F.regexp_replace(root, "[^a-z0-9]", "")
    )
    return F.array_distinct(F.filter(forms, lambda x: x != ""))


def url_escape(c: Column) -> Column:
    """Percent-encoding with %20 for spaces."""
    return F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))


def board_slug(html: Column | str, final_url: Column | str) -> Column:
    """F16: (platform, slug) of the first job board that a page points to, or that its text is marked with (the slug
    may then be empty); null if none."""
    text = F.concat_ws("\n", col(html), col(final_url))
    steps = []
    for platform, pattern in W.BOARD_PATTERNS:
        slug = F.lower(F.regexp_extract(text, pattern, 1))
        steps.append(F.when((F.length(slug) >= 2) & ~slug.isin(*W.NO_SLUGS), F.struct(F.lit(platform).alias("platform"), slug.alias("slug"))))
    page = F.coalesce(col(html), F.lit(""))
    marked = page.rlike("(?i)" + "|".join(m.replace(".", r"\.") for m in W.TEAMTAILOR_MARKERS))
    slug = F.lower(F.regexp_extract(page, r"(?i)https?://([a-z0-9-]+)\.teamtailor\.com", 1))
    steps.append(F.when(marked, F.struct(F.lit("teamtailor").alias("platform"), slug.alias("slug"))))
    return F.coalesce(*steps)


def workday_parts(html: Column | str, final_url: Column | str) -> Column:
    """F16: (tenant, pod, site) of a Workday address in the final address, or else in the page."""
    def parts(c: Column) -> Column:
        tenant, pod, site = (F.regexp_extract(c, W.WORKDAY, k) for k in (1, 2, 3))
        usable = (tenant != "") & ~F.lower(site).isin("login", "auth", "home", "search", "external")
        return F.when(usable, F.struct(F.lower(tenant).alias("tenant"), pod.alias("pod"), site.alias("site")))

    return F.coalesce(parts(col(final_url)), parts(col(html)))


def safe_name(c: Column | str) -> Column:
    """a name for files."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(slug == "", "story").otherwise(slug)


def _replaced(c: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def escape_md(c: Column | str) -> Column:
    """pipes escaped for tables."""
    return _replaced(F.coalesce(col(c), F.lit("")), [("|", "\\|")])


def escape_html(c: Column | str) -> Column:
    """the three characters of markup escaped."""
    return _replaced(F.coalesce(col(c), F.lit("")), [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")])


def salary_text(currency: Column, low: Column, high: Column, unit: Column, style: str = "page") -> Column:
    """a range, a minimum, or null. Styles: page (``EUR 1–2 YEAR``), plain (``EUR 1 - 2 YEAR``)."""
    dash = "–" if style == "page" else " - "
    part = F.when(low.isNotNull() & high.isNotNull(), F.concat(low.cast("string"), F.lit(dash), high.cast("string"))).when(low.isNotNull(), F.concat(low.cast("string"), F.lit("+")))
    return F.when(part.isNotNull(), strip(F.concat_ws(" ", F.coalesce(currency, F.lit("")), part, F.coalesce(unit, F.lit("")))))


def location_text(*parts: Column) -> Column:
    """the parts that aren't blank, by commas; null if none."""
    return F.nullif(F.concat_ws(", ", *(F.nullif(strip(p), F.lit("")) for p in parts)), F.lit(""))


def story_line(headline: Column, relevance: Column, url: Column) -> Column:
    """one story of a post."""
    return F.concat(headline, F.lit(" - "), F.regexp_replace(relevance, r"\.+$", ""), F.lit(". read more-"), url)


def meta_line(*parts: Column) -> Column:
    """the parts that aren't blank, by middle dots."""
    return F.concat_ws(" · ", *(F.nullif(p, F.lit("")) for p in parts))


def hashtags(tags: Column) -> Column:
    """tags with one hash sign each."""
    return F.array_join(F.transform(tags, lambda t: F.concat(F.lit("#"), F.regexp_replace(t, "^#+", ""))), " ")


def first_token(c: Column | str) -> Column:
    """the first word of a cell; null if there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(col(c), F.lit("")), r"(?U)(\S+)", 1), F.lit(""))


def collapse(c: Column | str) -> Column:
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")


def content_hash(value: Column) -> Column:
    """the first eight digits of the SHA-256 of a value's JSON."""
    return F.substring(F.sha2(F.to_json(value), 256), 1, 8)


def join_nonempty(items: Column, sep: str = ", ") -> Column:
    """the items that aren't empty, joined."""
    return F.array_join(F.filter(F.coalesce(items, F.array().cast("array<string>")), lambda x: x.isNotNull() & (x != "")), sep)


def rewrite_notes(notes: Column, drop_prefixes: list[str], new_lines: list[str]) -> Column:
    """notes without the lines of some prefixes, with new lines at the end."""
    kept = F.filter(F.split(F.coalesce(notes, F.lit("")), "\n"), lambda x: ~reduce(lambda a, b: a | b, (x.startswith(p) for p in drop_prefixes), F.lit(False)))
    kept = F.filter(kept, lambda x: x != "")
    return F.array_join(F.concat(kept, F.array(*(F.lit(x) for x in new_lines)).cast("array<string>")), "\n")
