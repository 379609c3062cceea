"""The discovery jobs: pages or snapshots in, one outcome per scanned article out.

Each job is one plan over all its sources. Work is saved by order: unchanged listing
pages, known URLs and the limits cut the links before any article page is looked up,
and the extractor only sees rows that passed every cheap check.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.answers import parse_extraction
from newsloom.functions.identity import content_hash, entry_key, link_list_hash
from newsloom.functions.urls import canonical_url
from newsloom.operators.articles import (
    NOT_FETCHED,
    apply_fallback,
    extract_articles,
    fetch_pages,
    is_thin_page,
    join_articles,
)
from newsloom.operators.change import change_status, fresh_links, section_diff, unfinished
from newsloom.operators.classify import accepted, classify, early_reason, to_extract
from newsloom.operators.extract import Extractor, extract_with
from newsloom.operators.journal import AnswerJournal
from newsloom.operators.links import by_source, explode_links, listing_links
from newsloom.operators.select import (
    cap_items,
    cap_new_rows,
    first_sections,
    is_window_cap,
    mark_duplicates,
)
from newsloom.operators.skew import is_small, keep_first, spread_join
from newsloom.operators.snapshots import (
    paywall_sql,
    read_attempts,
    select_attempts,
    snapshot_links,
)
from newsloom.session import stage
from newsloom.sources.store import Store
from newsloom.sources.tables import seeds as seed_rows
from newsloom.specs import RunConfig, SourceSpec, enabled


@dataclass(frozen=True)
class State:
    """What earlier runs left behind; None where there is nothing. Of a ``store``, runs look
    up the rows of their own URLs (``near``); its URLs are canonical."""

    news: DataFrame | None = None
    url_index: DataFrame | None = None
    section_snapshot: DataFrame | None = None
    store: Store | None = None
    version: str | None = None

    @staticmethod
    def of(store: Store, version: str) -> State:
        """The tables of a store as they were before the run ``version``."""
        return State(
            store.read("news", version),
            store.read("url_index", version),
            store.read("section_snapshot", version),
            store,
            version,
        )

    def near(self, links: DataFrame, url: str = "url") -> State:
        """The state cut to the URLs of ``links``, which is read several times. Tables that
        are not of a store stay whole."""
        if self.store is None:
            return self
        return replace(
            self,
            news=self.store.look_up("news", links, url, self.version),
            url_index=self.store.look_up("url_index", links, url, self.version),
        )


@dataclass(frozen=True)
class Found:
    """``sections``: one row per processed listing page with ``action`` and ``reason``.
    ``candidates``: one row per scanned link with its article. ``wanted``: where a limit
    may have left links out, all that were to be scanned (run_id, source_id, url).
    ``left_sections``: the listing pages that a limit leaves to later runs."""

    sections: DataFrame
    candidates: DataFrame
    wanted: DataFrame | None = None
    left_sections: DataFrame | None = None


CANDIDATE_COLUMNS = (
    "run_id", "source_id", "source_ord", "section_ord", "link_pos", "url", "fetch_error",
    "paywalled", "title", "body_excerpt",
)
SECTION_COLUMNS = (
    "run_id", "source_id", "section_url", "section_key", "link_hash", "action", "reason",
)


def _section_action(fetch_error: str = "fetch_error") -> list:
    failed = F.col(fetch_error).isNotNull()
    return [
        F.when(failed, F.lit("error"))
        .when(F.col("is_unchanged"), F.lit("section_unchanged"))
        .alias("action"),
        F.when(F.col(fetch_error).startswith("section_parse: "), F.col(fetch_error))
        .when(failed, F.concat(F.lit("section_fetch: "), F.col(fetch_error)))
        .when(F.col("is_unchanged"), F.lit("unchanged"))
        .alias("reason"),
    ]


def join_sections(
    seeds: DataFrame, pages: DataFrame, max_sections: int | None = None
) -> DataFrame:
    """Listing pages of the seeds: ``html``, or ``fetch_error`` where there is none.

    ``section_key`` is the canonical URL by which the page is looked up;
    ``max_sections`` a bound on the seeds known beforehand."""
    keyed = seeds.withColumn("section_key", canonical_url("section_url"))
    keys = keyed.select(F.col("section_key").alias("url")).distinct()
    found = fetch_pages(keys, pages, max_sections).withColumnRenamed("url", "section_key")
    return keyed.join(found, "section_key", "left").withColumn(
        "fetch_error",
        F.coalesce("fetch_error", F.when(F.col("html").isNull(), F.lit(NOT_FETCHED))),
    )


def _latest_snapshots(
    snapshots: DataFrame, keys: DataFrame, max_keys: int | None
) -> DataFrame:
    wanted = keys.select("url").distinct()
    keyed = snapshots.withColumn("_raw", F.col("url")).withColumn("url", canonical_url("url"))
    if is_small(max_keys):
        hits = keyed.join(F.broadcast(wanted), "url")
    else:
        hits = spread_join(keyed, wanted, ["url"], "inner")
    return keep_first(hits, ["url"], ["attempt", "_raw"], last=True).drop("_raw")


def _drop_known(
    links: DataFrame, specs: Sequence[SourceSpec], state: State
) -> DataFrame:
    """Without the URLs that are in the news, for the sources that want fresh ones only."""
    picky = [s.source_id for s in specs if s.fresh_only]
    if state.news is None or not picky:
        return links
    if state.store is not None:
        links = stage(links, "found-links")
    chosen = F.col("source_id").isin(picky)
    some = links if len(picky) == len(specs) else links.where(chosen)
    fresh = fresh_links(some, state.near(some).news, canonical=state.store is not None)
    return fresh if len(picky) == len(specs) else links.where(~chosen).unionByName(fresh)


def html_candidates(
    seeds: DataFrame,
    pages: DataFrame,
    specs: Sequence[SourceSpec],
    config: RunConfig,
    state: State = State(),
    snapshots: DataFrame | None = None,
    parser: str = "dom",
    max_sections: int | None = None,
) -> Found:
    """Listing pages to scanned articles, for sources of HTML pages.

    ``max_sections`` is a bound on the number of seeds known beforehand, None when the
    seeds are a table of unknown size."""
    first, left = _choose_sections(seeds, config, state)
    listings = join_sections(first, pages, max_sections)
    most = config.max_rows(specs)
    if config.snapshot_fallback and snapshots is not None:
        # a thin listing page would be read from its snapshot, which shows no links
        seen = snapshots.select(canonical_url("url").alias("section_key")).distinct()
        listings = listings.join(
            seen.withColumn("_seen", F.lit(True)), "section_key", "left"
        ).withColumn(
            "html",
            F.when(
                is_thin_page("html", config.min_html_chars) & F.col("_seen"), F.lit("")
            ).otherwise(F.col("html")),
        )
    listings = (
        listing_links(listings, specs, parser=parser)
        .withColumn("run_id", F.lit(config.run_id))
        .withColumn("link_hash", link_list_hash("links"))
        .drop("html")
    )
    # every later step reads the links: keep them, and parse each listing page once
    sections = stage(section_diff(listings, state.section_snapshot), "sections")

    links = explode_links(
        sections.where(F.col("fetch_error").isNull()).select(
            "run_id", "source_id", "source_ord", "section_ord", "is_unchanged", "links"
        )
    )
    if state.url_index is None:
        links = links.where(~F.col("is_unchanged"))
    else:
        # only the links of unchanged listings need the index
        same = links.where("is_unchanged")
        near = state.near(same)
        again = spread_join(
            same, unfinished(near.url_index, near.news, config.entry_key_prefix), ["url"],
            "left_semi",
        )
        links = links.where(~F.col("is_unchanged")).unionByName(again)
    links = _drop_known(links.drop("is_unchanged"), specs, state)
    if config.max_items is not None:
        links = stage(links, "links")
    # every later step reads the scanned links
    scanned = stage(cap_items(links, config.max_items), "scanned")

    keys = scanned.select("source_id", "url").distinct()
    fetched = fetch_pages(keys, pages, most)
    articles = extract_articles(fetched, specs, None)
    if config.snapshot_fallback and snapshots is not None:
        articles = apply_fallback(
            articles,
            _latest_snapshots(snapshots, keys, most),
            specs,
            None,
            config.min_html_chars,
            max_rows=most,
        )
    candidates = join_articles(
        scanned, articles.drop("html"), ["source_id", "url"], most
    ).withColumn("paywalled", F.lit(False))
    done = sections.select("*", *_section_action())
    return Found(
        done.select(*SECTION_COLUMNS),
        candidates.select(*CANDIDATE_COLUMNS),
        _wanted(links, config),
        left,
    )


def _choose_sections(
    seeds: DataFrame, config: RunConfig, state: State
) -> tuple[DataFrame, DataFrame | None]:
    """The listing pages of this run, and those a limit leaves out (run_id, source_id,
    section_url)."""
    if config.max_sections is None:
        return seeds, None
    chosen = stage(first_sections(seeds, config.max_sections, state.section_snapshot), "seeds")
    left = seeds.join(
        chosen.select("source_id", "section_url"), ["source_id", "section_url"], "left_anti"
    )
    return chosen, left.select(F.lit(config.run_id).alias("run_id"), "source_id", "section_url")


def _wanted(links: DataFrame, config: RunConfig) -> DataFrame | None:
    """The links before the limits, if there are any."""
    if config.max_items is None and config.max_new_rows is None:
        return None
    return links.select("run_id", "source_id", "url")


def left_out(wanted: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``run_id, source_id, url`` of the links that a limit kept from being scanned."""
    key = ["run_id", "source_id", "url"]
    return wanted.distinct().join(outcomes.select(*key).distinct(), key, "left_anti")


def snapshot_candidates(
    seeds: DataFrame,
    snapshots: DataFrame,
    specs: Sequence[SourceSpec],
    config: RunConfig,
    state: State = State(),
    max_sections: int | None = None,
) -> Found:
    """Listing snapshots to scanned articles, for sources read through snapshots.

    ``max_sections`` is a bound on the number of seeds known beforehand; the few listing
    snapshots are then found without moving the others.

    A listing may have several snapshots, one per scroll step; their links are merged
    in the order seen. A listing behind a login wall ends its source with an error."""
    first, left = _choose_sections(seeds, config, state)
    first = first.withColumn("section_key", canonical_url("section_url"))
    keyed = snapshots.withColumn("url", canonical_url("url"))
    # a listing may hold most of the snapshots: its steps are spread, not grouped
    listed = keyed.withColumnRenamed("url", "section_key")
    if is_small(max_sections):
        steps = listed.join(F.broadcast(first), "section_key")
    else:
        steps = spread_join(listed, first, ["section_key"], "inner")
    read = snapshot_links(steps, specs).withColumn(
        "wall", F.expr(by_source(specs, lambda s: paywall_sql("snapshot", s.paywall)))
    )
    read = stage(read.drop("snapshot"), "listing-steps")

    walls = read.groupBy("source_id", "section_url").agg(F.max("wall").alias("wall"))
    wall = F.col("wall")
    sections = first.join(walls, ["source_id", "section_url"], "left").select(
        F.lit(config.run_id).alias("run_id"),
        "source_id",
        "section_url",
        "section_key",
        F.lit(None).cast("string").alias("link_hash"),
        F.when(wall.isNull() | wall, F.lit("error")).alias("action"),
        F.when(wall.isNull(), F.lit(f"section_fetch: {NOT_FETCHED}"))
        .when(wall, F.lit("login_required"))
        .alias("reason"),
    )
    # at most one row per configured source
    walled = walls.where("wall").select("source_id").distinct()
    links = explode_links(
        read.select("source_id", "source_ord", "section_ord", "attempt", "links")
    ).join(F.broadcast(walled), "source_id", "left_anti")
    merged = keep_first(
        links, ["source_id", "source_ord", "section_ord", "url"], ["attempt", "link_pos"]
    ).select(
        F.lit(config.run_id).alias("run_id"),
        "source_id",
        "source_ord",
        "section_ord",
        "url",
        # one place per step and position; only the order counts
        (F.shiftleft(F.col("attempt").cast("long"), 32) + F.col("link_pos")).alias("link_pos"),
    )
    links = _drop_known(merged, specs, state)
    if config.max_items is not None:
        links = stage(links, "links")
    scanned = stage(cap_items(links, config.max_items), "scanned")
    most = config.max_rows(specs)

    keys = scanned.select("source_id", "url").distinct()
    if is_small(most):
        tried = keyed.join(F.broadcast(keys), "url")
    else:
        tried = spread_join(keyed, keys, ["url"], "inner")
    parsed = read_attempts(tried, specs, None)
    chosen = select_attempts(parsed, ["source_id", "url"], config.max_attempts)
    articles = chosen.select(
        "source_id",
        "url",
        "title",
        "body_excerpt",
        "paywalled",
        F.lit(None).cast("string").alias("fetch_error"),
    )
    candidates = join_articles(scanned, articles, ["source_id", "url"], most).withColumn(
        "paywalled", F.coalesce("paywalled", F.lit(False))
    )
    return Found(
        sections.select(*SECTION_COLUMNS),
        candidates.select(*CANDIDATE_COLUMNS),
        _wanted(links, config),
        left,
    )


def page_candidates(
    pages: DataFrame, specs: Sequence[SourceSpec], config: RunConfig
) -> DataFrame:
    """Every fetched page as a candidate of its own, without listing pages.

    ``pages`` carries ``source_id``, ``source_ord``, ``section_ord`` and ``link_pos``."""
    return (
        extract_articles(pages, specs, None)
        .withColumn("run_id", F.lit(config.run_id))
        # a URL that cannot be read keeps its text for the error row
        .withColumn("raw_url", F.col("url"))
        .withColumn("url", canonical_url("url"))
        .withColumn("paywalled", F.lit(False))
        .select(*CANDIDATE_COLUMNS, "raw_url")
    )


def settle(
    candidates: DataFrame,
    specs: Sequence[SourceSpec],
    config: RunConfig,
    state: State = State(),
    extractor: Extractor | None = None,
    parallelism: int | None = None,
    answers: str | None = None,
    journal: AnswerJournal | None = None,
) -> DataFrame:
    """One outcome per candidate: identity, duplicates, change, extraction, decision, limit.

    The row order of a source only matters for duplicates and the limit on new rows;
    everything between runs in parallel over all rows. The candidates have been cut to
    ``config.max_items`` per source; they are staged for look-ups in a store, and without
    that limit, as the look-up in the URL index reads them twice. ``answers`` names a column of
    raw answers that were obtained beforehand; it takes the place of the extractor. With a
    ``journal`` only payloads are asked that no run has answered. Candidates that come with
    a ``change_status`` are not looked up in the state."""
    on = extractor is not None or answers is not None
    most = config.max_rows(specs)
    judged = "change_status" in candidates.columns
    if not judged:
        if state.store is not None or (state.url_index is not None and not is_small(most)):
            candidates = stage(candidates, "candidates")
        state = state.near(candidates)
    keyed = (
        candidates.withColumn(
            "min_body_chars", F.expr(by_source(specs, lambda s: str(s.min_body_chars)))
        )
        .withColumn("early_reason", early_reason())
        .withColumn(
            "content_hash",
            F.when(F.col("early_reason").isNull(), content_hash("title", "body_excerpt")),
        )
        .withColumn("entry_key", entry_key("url", "content_hash", config.entry_key_prefix))
    )
    known = keyed if judged else change_status(
        keyed, state.url_index, state.news, config.entry_key_prefix, max_rows=most
    )
    flagged = mark_duplicates(known, config.max_items)
    if answers is not None:
        answered = flagged.withColumn(
            "extraction", F.when(to_extract(True), parse_extraction(answers))
        ).drop(answers)
    else:
        if parallelism is not None and on and journal is None:
            flagged = stage(flagged, "flagged")
        answered = extract_with(
            flagged, extractor, to_extract(on), config.extract_max_chars,
            parallelism if on else None, seconds=config.extract_seconds, journal=journal,
            run_id=config.run_id,
        )
    if "raw_url" in answered.columns:
        answered = answered.withColumn("url", F.coalesce("url", "raw_url")).drop("raw_url")
    decided = classify(answered, on, config.status_mode)
    if config.max_new_rows is not None and not is_window_cap(config.max_items):
        decided = stage(decided, "decided")  # the extractor must not run again for the limit
    return cap_new_rows(decided, config.max_new_rows, accepted(), config.max_items)


def discover(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    config: RunConfig,
    pages: DataFrame | None = None,
    snapshots: DataFrame | None = None,
    state: State = State(),
    extractor: Extractor | None = None,
    parallelism: int | None = None,
    journal: AnswerJournal | None = None,
) -> Found:
    """All enabled sources in one job, HTML and snapshot sources side by side.

    A page, answer or URL that fails becomes an error row; it does not stop the rest."""
    active = enabled(specs)
    seeds = seed_rows(spark, active)
    parts = []
    for kind, table in (("html", pages), ("snapshot", snapshots)):
        chosen = [s for s in active if s.kind == kind]
        if not chosen or table is None:
            continue
        own = seeds.where(F.col("source_id").isin([s.source_id for s in chosen]))
        if kind == "html":
            sections = sum(len(s.sections) for s in chosen)
            parts.append(
                html_candidates(
                    own, table, chosen, config, state, snapshots, max_sections=sections
                )
            )
        else:
            sections = sum(len(s.sections) for s in chosen)
            parts.append(
                snapshot_candidates(own, table, chosen, config, state, max_sections=sections)
            )
    if not parts:
        raise ValueError("no enabled source has pages or snapshots to read")
    def united(frames: list[DataFrame | None]) -> DataFrame | None:
        if frames[0] is None:  # a limit holds for all kinds of sources or for none
            return None
        return reduce(lambda a, b: a.unionByName(b), frames)

    candidates = united([p.candidates for p in parts])
    outcomes = settle(
        candidates, active, config, state, extractor, parallelism, journal=journal
    )
    return Found(
        united([p.sections for p in parts]), outcomes, united([p.wanted for p in parts]),
        united([p.left_sections for p in parts]),
    )


def with_run(config: RunConfig, run_id: str) -> RunConfig:
    """The same settings under another run id."""
    return replace(config, run_id=run_id)
