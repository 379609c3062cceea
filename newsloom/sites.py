"""The two built-in sources, their listing pages, rules and selectors."""

from __future__ import annotations

from newsloom.specs import (
    MIN_SNAPSHOT_BODY_CHARS,
    ArticleRule,
    PaywallMarkers,
    Section,
    Selectors,
    SourceSpec,
)

AGFUNDER = SourceSpec(
    source_id="agfunder",
    host="agfundernews.com",
    sections=(
        Section("homepage", "https://agfundernews.com/", "high"),
        Section("tag-agtech", "https://agfundernews.com/tag/agtech", "high"),
        Section("tag-foodtech", "https://agfundernews.com/tag/foodtech", "high"),
        Section("tag-startups", "https://agfundernews.com/tag/startups", "high"),
        Section("tag-investor-qa", "https://agfundernews.com/tag/investor-qa", "medium"),
        Section("tag-insect-ag", "https://agfundernews.com/tag/insect-ag", "medium"),
        Section("tag-video", "https://agfundernews.com/tag/video", "low"),
        Section(
            "tag-global-report-2026", "https://agfundernews.com/tag/global-report-2026", "low"
        ),
    ),
    article_rule=ArticleRule(
        excluded_paths=("/", "/about", "/newsletter"),
        blocked_prefixes=("/tag/", "/news/page/", "/wp-"),
        path_pattern=r"(?i)\A/[a-z0-9-]+\z",
    ),
    non_article_prefixes=(
        "/about", "/newsletter", "/wp-content", "/wp-includes", "/tag/", "/news/page/",
        "/search", "/privacy", "/terms",
    ),
    selectors=Selectors(
        titles=("h1", "title", 'meta[property="og:title"]'),
        bodies=(
            ".article-content .text-wrapper",
            ".article-content .content-column",
            ".article-content",
        ),
    ),
)

INC42_FEED = SourceSpec(
    source_id="inc42",
    host="inc42.com",
    kind="snapshot",
    sections=(
        Section("agritech-industry", "https://inc42.com/industry/agritech/", "high", "browser"),
    ),
    article_rule=ArticleRule(
        excluded_paths=("/", "/about", "/newsletter", "/login"),
        path_prefixes=("/buzz/", "/features/", "/startups/"),
        min_segments=2,
        ignore_case=True,
    ),
    non_article_prefixes=(
        "/about", "/newsletter", "/tag/", "/industry/", "/category/", "/author/", "/page/",
        "/feed/", "/courses/", "/reports/", "/events/", "/brandlabs/", "/login", "/datalabs/",
        "/wp-content", "/wp-includes", "/search", "/privacy", "/terms", "/markets",
        "/resources", "/glossary",
    ),
    selectors=Selectors(
        titles=("h1.entry-title", 'meta[property="og:title"]'),
        bodies=(".single-post-content", ".entry-content", "article"),
    ),
    paywall=PaywallMarkers(
        any_of=("sign in to continue", "sign in to read"),
        all_of=("sign in", "join inc42"),
    ),
    min_body_chars=MIN_SNAPSHOT_BODY_CHARS,
    fresh_only=True,
)

# The same source over plain HTML pages.
INC42_PAGES = SourceSpec(
    source_id=INC42_FEED.source_id,
    host=INC42_FEED.host,
    sections=(
        Section("homepage", "https://inc42.com/", "high"),
        Section(
            "ipo-tracker", "https://inc42.com/features/indian-startup-ipo-tracker-2026/", "high"
        ),
    ),
    article_rule=INC42_FEED.article_rule,
    non_article_prefixes=INC42_FEED.non_article_prefixes,
    selectors=INC42_FEED.selectors,
)

# Order of the sources in a cycle.
SOURCES = (INC42_FEED, AGFUNDER)
