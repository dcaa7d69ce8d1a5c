"""Every query again as SQL over the generated tables, for the check engine.

The statements are written from the meaning of each operator: exact sums as whole numbers of 2**-60, rounding
through ``printf`` (exact on the binary value, ties to even).  They share only the
plain-SQL input bindings with the queries.
"""

from __future__ import annotations

from testbed.bindings import TEXT, titles_side

CHECKS: dict[str, str] = {}


def even(value: str, digits: int) -> str:
    return f"(cast(printf('%.{digits}f', cast({value} as double)) as double) + 0.0)"


def half_up(value: str, digits: int) -> str:
    """Half-up on the printed decimal text."""
    return f"cast(round(cast(cast(cast({value} as double) as varchar) as decimal(38, 18)), {digits}) as double)"


_UNIT = "1152921504606846976"  # 2**60


def units(value: str) -> str:
    """A double as a whole number of 2**-60."""
    number = f"cast({value} as double)"
    return f"(cast(floor({number}) as hugeint) * {_UNIT} + cast(({number} - floor({number})) * cast({_UNIT} as double) as hugeint))"


def as_double(whole: str) -> str:
    """A whole number of 2**-60 as a double, rounded once: the leading parts are exact."""
    half = "1073741824"
    return (
        f"(cast(({whole}) // {_UNIT} as double) + cast((({whole}) % {_UNIT}) // {half} as double) / {half}"
        f" + cast((({whole}) % {half}) as double) / {half} / {half})"
    )


def total(value: str, over: str = "") -> str:
    return as_double(f"sum({units(value)}) {over}")


def mean(value: str, over: str = "") -> str:
    return f"({total(value, over)} / nullif(count({value}) {over}, 0))"


BASE = {name: text.replace("{", "").replace("}", "") for name, text in TEXT.items()}

# ---- inputs the queries read from JSON or CSV text, here from the tables' own columns ------------------------

BASE["seed"] = """
    select trim(game_id) as game_id, trim(name) as name, try_cast(trim(steam_appid) as bigint) as steam_appid,
           nullif(trim(twitch_category), '') as twitch_category, nullif(trim(wikipedia_article), '') as wikipedia_article,
           nullif(trim(subreddit), '') as subreddit, nullif(trim(trends_term), '') as trends_term,
           case trim(storefronts) when 'own |' then 'own' else coalesce(storefronts, '') end as storefronts
    from seed_cells"""

BASE["snaps"] = """
    select event_id, event_type, user_id, k, event_id % 101 = 0 as broken,
           case when event_id % 50 <> 0 then cast(ts as date) end as day,
           case event_type when 'view' then 'twitch_helix' when 'click' then 'steam_ccu' when 'purchase' then 'wikipedia_pageviews'
                when 'signup' then 'google_trends' else 'reddit' end as source,
           case event_type when 'view' then 'cat ' || user_id when 'click' then cast(user_id as varchar)
                when 'purchase' then 'art_' || user_id when 'signup' then 'term ' || user_id
                else 'sub' || (user_id - user_id % 2) end as entity_key
    from (select *, cast(regexp_extract(props, '[0-9]+') as bigint) as k from events) e"""

# Valid values per signal.
BASE["vals"] = """
    select *, case when event_type = 'view' and not broken and k % 17 <> 0 then k * 7 end as viewers,
           case when event_type = 'view' and not broken and k % 17 <> 0 then k % 9 end as channels,
           case when event_type = 'click' and not broken and k % 13 <> 0 and k >= 3 then k - 3 end as players,
           case when event_type = 'purchase' and not broken and k % 19 <> 0 then k end as views,
           case when event_type = 'signup' and not broken then k / 4 end as idx,
           case when event_type = 'error' and not broken then k * 1000 + event_id % 3 end as subscribers,
           case when event_type = 'error' and not broken and k % 6 >= 1 then k % 6 - 1 end as posts
    from snaps"""

BASE["xwalk"] = """
    select source, entity_key, max(game_id) as game_id from (
        select 'twitch_helix' as source, twitch_category as entity_key, game_id from seed
        union all select 'wikipedia_pageviews', wikipedia_article, game_id from seed
        union all select 'google_trends', trends_term, game_id from seed
        union all select 'reddit', subreddit, game_id from seed
        union all select s, cast(steam_appid as varchar), game_id from seed,
            (values ('steam_ccu'), ('steam_reviews'), ('steamspy_snapshot'), ('gamalytic')) as v(s)
    ) c where entity_key is not null group by source, entity_key"""

BASE["known"] = "select v.*, c.game_id from vals v join xwalk c using (source, entity_key)"

BASE["daily"] = f"""
    select game_id, day as date,
           {even("sum(viewers) / count(viewers)", 2)} as twitch_avg_viewers, cast(max(viewers) as bigint) as twitch_peak_viewers,
           {even("sum(channels) / count(viewers)", 2)} as twitch_avg_channels, cast(max(views) as bigint) as wiki_pageviews,
           {even("sum(idx) / count(idx)", 2)} as trends_index, cast(max(posts) as bigint) as reddit_posts,
           cast(round_even(sum(subscribers) / count(subscribers), 0) as bigint) as reddit_subscribers,
           cast(max(players) as bigint) as steam_ccu_peak
    from known
    where day is not null and coalesce(viewers, players, views, cast(ceil(idx) as bigint), subscribers, posts) is not null
    group by game_id, day"""

BASE["page_reviews"] = """
    select conv_id, turn, cast((conv_id % 40) * 100 + turn as varchar) as review_id,
           1577000000 + conv_id * 100000 + turn * 1000 as review_ts, role = 'user' as voted_up,
           cast(length(text) as bigint) as playtime_at_review_min, role as language, turn % 3 = 0 as received_free
    from conversations where conv_id % 29 <> 0 and not (turn = 5 and conv_id % 3 = 0)"""

BASE["est_rows"] = """
    select o_orderkey as k, o_custkey, cast(o_orderdate as date) as day, o_orderpriority >= '4' as tiers,
           case when o_orderkey % 37 = 0 then 'x' || o_custkey else cast(o_custkey as varchar) end as entity_key,
           cast(floor(o_totalprice) as bigint) as low, o_totalprice
    from orders"""

BASE["est_parsed"] = """
    select entity_key, k, day,
           case when tiers then low end as est_owners_low, case when tiers then low * 2 end as est_owners_high,
           case when not tiers then case when k % 31 = 0 then low // 4 + 0 else low end end as est_units_lifetime,
           case when not tiers and k % 31 <> 0 and k % 23 <> 0 then o_totalprice end as est_revenue_lifetime_usd,
           case when tiers then 'steamspy' else 'gamalytic' end as est_source, tiers
    from est_rows where case when tiers then k % 19 <> 0 else k % 29 <> 0 end"""

BASE["store_all"] = """
    select p_partkey as appid, p_name || ' ' || p_brand as name, v.version,
           case p_partkey % 6 when 4 then null when 5 then null else 1990 + p_partkey % 35 end as release_year,
           p_size % 5 = 0 as is_free,
           cast(case when p_size % 5 = 0 or p_partkey % 9 = 0 then 0 else floor(p_retailprice) + v.version end as bigint) as price_cents,
           true as supports_windows, p_partkey % 2 = 0 as supports_mac, p_partkey % 5 = 0 as supports_linux,
           case when p_partkey % 8 <> 0 then p_type else 'Unknown' end as primary_genre,
           case when p_partkey % 8 <> 0 then p_type || '|' || p_brand else 'Unknown' end as genre_list,
           cast(1704067200 + v.version as bigint) as ingested_at
    from part, (values (1), (2)) as v(version)
    where (v.version = 1 or p_partkey % 3 = 0) and p_partkey % 53 <> 0 and p_partkey % 47 <> 0"""

BASE["store"] = "select * from store_all s where version = (case when appid % 3 = 0 then 2 else 1 end)"

BASE["dim_rows"] = """
    select coalesce(e.game_id, coalesce(nullif(trim(regexp_replace(lower(s.name), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown')) as game_id,
           coalesce(e.name, s.name) as title, case when e.storefronts <> '' then e.storefronts else 'steam' end as fronts,
           e.game_id is not null as seeded, s.*
    from store s left join seed e on e.steam_appid = s.appid"""

BASE["dim_best"] = """
    select * from (select *, row_number() over (partition by game_id order by seeded desc, ingested_at desc, appid desc) as rn
                   from dim_rows) r where rn = 1"""

BASE["dim"] = """
    select coalesce(b.game_id, e.game_id) as game_id, coalesce(b.title, e.name) as name,
           coalesce(b.appid, e.steam_appid) as steam_appid, coalesce(b.appid, e.steam_appid) is not null as on_steam,
           coalesce(b.fronts, e.storefronts) as storefronts, cast(b.release_year as int) as release_year, b.is_free, b.price_cents,
           coalesce(b.supports_windows, true) as supports_windows, b.supports_mac, b.supports_linux, b.primary_genre,
           coalesce(b.genre_list, '') as genre_list,
           case when e.game_id is null then b.name else e.twitch_category end as twitch_category,
           e.wikipedia_article, e.subreddit,
           case when e.game_id is null then b.name else e.trends_term end as trends_term
    from seed e full join dim_best b on e.game_id = b.game_id"""

# ---- derived tables ------------------------------------------------------------------------------------------

BASE["platforms"] = f"""
    select release_year, platform, count(*) as title_count,
           {even("count(*) filter (where is_free) / count(*)", 4)} as free_pct,
           {even("sum(price_cents) / count(price_cents)", 2)} as avg_price_cents
    from (select *, 'windows' as platform from catalogue where supports_windows
          union all select *, 'mac' from catalogue where supports_mac
          union all select *, 'linux' from catalogue where supports_linux) u
    where release_year is not null group by release_year, platform"""

BASE["genres"] = f"""
    select g.release_year, g.primary_genre, g.title_count, {even("g.title_count / y.n", 4)} as release_share, g.avg_price_cents
    from (select release_year, coalesce(primary_genre, 'Unknown') as primary_genre, count(*) as title_count,
                 {even("sum(price_cents) / count(price_cents)", 2)} as avg_price_cents
          from catalogue where release_year is not null group by release_year, coalesce(primary_genre, 'Unknown')) g
    join (select release_year, count(*) as n from catalogue where release_year is not null group by release_year) y
      on g.release_year = y.release_year"""

BASE["weekly"] = f"""
    select game_id, cast(date_trunc('week', date) as date) as week,
           {mean("twitch_avg_viewers")} as twitch_avg_viewers, cast(sum(wiki_pageviews) as bigint) as wiki_pageviews,
           {mean("trends_index")} as trends_index, cast(sum(reddit_posts) as bigint) as reddit_posts
    from engagement
    where coalesce(twitch_avg_viewers, wiki_pageviews, trends_index, reddit_posts) is not null
    group by game_id, cast(date_trunc('week', date) as date)"""

_SIGNALS = {"twitch_avg_viewers": "twitch_idx", "wiki_pageviews": "wiki_idx", "trends_index": "trends_idx", "reddit_posts": "reddit_idx"}

BASE["observed"] = " union all ".join(
    f"select game_id, week, '{index}' as signal, cast({column} as double) as v from weekly where {column} is not null"
    for column, index in _SIGNALS.items()
)

_PAST = "over (partition by game_id, signal order by week rows between 13 preceding and 1 preceding)"

BASE["indexed"] = f"""
    select game_id, week, signal, case when base > 0 then {even("v / base * 100", 2)} end as idx
    from (select *, {mean("v", _PAST)} as base from observed) w where base is not null"""

BASE["pivoted"] = f"""
    select w.game_id, w.week, i.twitch_idx, i.wiki_idx, i.trends_idx, i.reddit_idx, w.twitch_avg_viewers, w.wiki_pageviews,
           {even(f'''{as_double(" + ".join(units(f"coalesce({i}, 0)") for i in _SIGNALS.values()))}
             / nullif((twitch_idx is not null)::int + (wiki_idx is not null)::int + (trends_idx is not null)::int + (reddit_idx is not null)::int, 0)''', 2)}
             as attention_index
    from weekly w left join (
        select game_id, week, {", ".join(f"max(idx) filter (where signal = '{i}') as {i}" for i in _SIGNALS.values())}
        from indexed group by game_id, week) i on w.game_id = i.game_id and w.week = i.week"""

BASE["attention"] = f"""
    select game_id, cast(week as varchar) as week, twitch_idx, wiki_idx, trends_idx, reddit_idx, attention_index,
           {even("attention_index - prev", 2)} as attention_wow_delta, twitch_avg_viewers, wiki_pageviews
    from (select *, last_value(attention_index ignore nulls) over (partition by game_id order by week
                    rows between unbounded preceding and 1 preceding) as prev from pivoted) p"""

BASE["top20"] = """
    select week, game_id, attention_index, cast(rn as int) as rank
    from (select *, row_number() over (partition by week order by attention_index desc, game_id) as rn
          from attention where attention_index is not null) r where rn <= 20"""

BASE["cohorts"] = f"""
    select w.week, c.cohort, coalesce(s.n, 0) as title_count,
           {even("coalesce(s.tw, 0) / nullif(t.tw, 0)", 4)} as twitch_viewer_share,
           {even("coalesce(s.wi, 0) / nullif(t.wi, 0)", 4)} as wiki_pageview_share,
           coalesce(k.n, 0) as top20_attention_titles
    from (select distinct week from attention) w cross join (values ('on_steam', true), ('off_steam', false)) as c(cohort, flag)
    left join (select week, on_steam, count(distinct game_id) as n, {total("coalesce(twitch_avg_viewers, 0)")} as tw,
                      {total("coalesce(wiki_pageviews, 0)")} as wi
               from attention join dimension using (game_id) group by week, on_steam) s on s.week = w.week and s.on_steam = c.flag
    left join (select week, {total("coalesce(twitch_avg_viewers, 0)")} as tw, {total("coalesce(wiki_pageviews, 0)")} as wi
               from attention join dimension using (game_id) group by week) t on t.week = w.week
    left join (select week, on_steam, count(*) as n from top20 join dimension using (game_id) group by week, on_steam) k
           on k.week = w.week and k.on_steam = c.flag"""

BASE["months"] = f"""
    select game_id, cast(date_trunc('month', date) as date) as month, {mean("twitch_avg_viewers")} as viewers,
           cast(coalesce(sum(reviews_posted), 0) as bigint) as reviews_posted
    from engagement group by game_id, cast(date_trunc('month', date) as date) having count(twitch_avg_viewers) > 0"""

BASE["ranked"] = """
    select *, rank - 0 as r0, lag(rank) over (partition by game_id order by month) - rank as rank_delta
    from (select *, row_number() over (partition by month order by viewers desc, game_id) as rank from months) m"""

BASE["newest"] = """
    select game_id, snapshot_date, est_source, est_revenue_lifetime_usd, est_units_lifetime
    from (select *, row_number() over (partition by game_id order by snapshot_date desc, est_source desc) as rn from estimates) e
    where rn = 1"""

BASE["monthly"] = f"""
    select r.game_id, cast(r.month as varchar) as month, {even("viewers", 2)} as twitch_avg_viewers, cast(rank as int) as rank,
           cast(rank_delta as int) as rank_delta, reviews_posted, n.est_revenue_lifetime_usd as est_revenue_snapshot
    from ranked r left join newest n on n.game_id = r.game_id"""

BASE["revenue"] = f"""
    select m.game_id, m.month, n.est_revenue_lifetime_usd, n.est_units_lifetime, m.reviews_posted, m.twitch_avg_viewers,
           {even("case when n.est_revenue_lifetime_usd <> 0 then n.est_revenue_lifetime_usd / nullif(m.twitch_avg_viewers, 0) end", 2)}
             as revenue_per_avg_viewer
    from monthly m left join newest n on n.game_id = m.game_id
    where m.game_id in (select game_id from dimension where on_steam)"""

_NEEDS = {
    "seed": ["seed_cells"], "vals": ["snaps"], "xwalk": ["seed"], "known": ["vals", "xwalk"], "daily": ["known"],
    "est_parsed": ["est_rows"], "store": ["store_all"], "dim_rows": ["store", "seed"], "dim_best": ["dim_rows"],
    "dim": ["seed", "dim_best"], "platforms": ["catalogue"], "genres": ["catalogue"], "weekly": ["engagement"],
    "observed": ["weekly"], "indexed": ["observed"], "pivoted": ["weekly", "indexed"], "attention": ["pivoted"],
    "top20": ["attention"], "cohorts": ["attention", "dimension", "top20"], "months": ["engagement"], "ranked": ["months"],
    "newest": ["estimates"], "monthly": ["ranked", "newest"], "revenue": ["monthly", "newest", "dimension"],
}


def _ordered(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        _ordered(_NEEDS.get(name, []), seen)
        if name not in seen:
            seen.append(name)
    return seen


def check(name: str, needs: str, select: str, **extra: str) -> None:
    """Register a statement that uses the named inputs; ``extra`` adds inputs of its own."""
    parts = [f"{n} as ({BASE[n]})" for n in _ordered(needs.split(), [])] + [f"{n} as ({t})" for n, t in extra.items()]
    CHECKS[name] = (f"with {', '.join(parts)} " if parts else "") + select


# ---- sources and sinks ---------------------------------------------------------------------------------------

_ENVELOPE = """
    select 'events' as source, cast(user_id as varchar) as entity_key, {day} as extract_date {more},
           '{{"event_id":' || event_id || ',"event_type":"' || event_type || '"}}' as payload from events"""
_AS_TEXT = _ENVELOPE.format(day="cast(cast(ts as date) as varchar)", more="")
_TYPED = _ENVELOPE.format(day="cast(ts as date)", more=", 1704067200 + event_id as ingested_at, 'batch-1' as batch_id")
check("s1_read_landing", "", _AS_TEXT)
check("s2_type_envelopes", "", _TYPED)
check("s2_drop_repeated_envelopes", "", _TYPED)
check("s3_append_bronze", "snaps", """
    select source, entity_key, day as extract_date, 'batch-1' as batch_id from snaps
    union all select source, entity_key, day, 'batch-2' from snaps where source = 'reddit'""")
check("s4_load_seed", "seed", "select * from seed")
check("s5_scan_by_source", "snaps", "select source, entity_key, day as extract_date from snaps where source in ('reddit', 'steam_ccu')")
check("s6_rebuild_partitioned", "platforms", "select * from platforms where platform <> 'mac'")
check("s7_absent_is_empty", "estimates", "select * from estimates")
check("s8_envelope", "", _AS_TEXT)

# ---- keyed upserts -------------------------------------------------------------------------------------------

_LISTS = {"array": "list_value", "empty": "cast([] as varchar[])"}
_OLD_TITLES, _NEW_TITLES = (titles_side(s, **_LISTS).replace("{customer}", "customer") for s in ("old", "new"))
check("m1_upsert_titles", "", """
    select coalesce(n.game_id, o.game_id) as game_id, case when n.game_id is null then o.name else n.name end as name,
           coalesce(n.steam_appid, o.steam_appid) as steam_appid,
           coalesce(n.on_steam, false) or coalesce(o.on_steam, false) as on_steam, cast(null as varchar) as storefronts,
           cast(coalesce(n.release_year, o.release_year) as int) as release_year, coalesce(n.is_free, o.is_free) as is_free,
           coalesce(n.price_cents, o.price_cents) as price_cents,
           coalesce(n.supports_windows, o.supports_windows) as supports_windows, coalesce(n.supports_mac, o.supports_mac) as supports_mac,
           coalesce(n.supports_linux, o.supports_linux) as supports_linux, coalesce(n.primary_genre, o.primary_genre) as primary_genre,
           array_to_string(case when len(n.genre_list) > 0 then n.genre_list when o.game_id is null then n.genre_list
                else o.genre_list end, '|') as genre_list,
           case when n.game_id is null then o.twitch_category else n.twitch_category end as twitch_category,
           cast(null as varchar) as wikipedia_article, cast(null as varchar) as subreddit, cast(null as varchar) as trends_term,
           case when n.game_id is null then o.source else n.source end as source, cast(null as bigint) as ingested_at
    from o full join n on o.game_id = n.game_id""", o=_OLD_TITLES, n=_NEW_TITLES)

_SNAPSHOT = ["twitch_avg_viewers", "twitch_peak_viewers", "twitch_avg_channels", "wiki_pageviews", "trends_index",
             "reddit_posts", "reddit_subscribers", "steam_ccu_peak"]
_OLD_DAYS = "select * from engagement where day(date) % 3 <> 0"
check("m2_upsert_engagement", "engagement", f"""
    select coalesce(n.game_id, o.game_id) as game_id, coalesce(n.date, o.date) as date,
           coalesce(case when day(n.date) % 5 <> 0 then n.twitch_avg_viewers * 2 end, o.twitch_avg_viewers) as twitch_avg_viewers,
           {", ".join(f"coalesce(n.{c} * 2, o.{c}) as {c}" for c in _SNAPSHOT[1:])},
           case when o.game_id is null then n.reviews_posted else o.reviews_posted end as reviews_posted,
           cast(null as double) as reviews_positive_share, case when n.game_id is not null then cast(1767225600 as bigint) end as ingested_at
    from o full join n on o.game_id = n.game_id and o.date = n.date""",
      o=_OLD_DAYS, n="select * from engagement where day(date) % 3 = 0 or day(date) % 2 = 0")
check("m3_upsert_reviews", "reviews", """
    select * from reviews where cast(review_id as bigint) % 3 <> 0 and cast(review_id as bigint) % 2 <> 0
    union all
    select game_id, review_id, review_ts, not voted_up, playtime_at_review_min, null, received_free
    from reviews where cast(review_id as bigint) % 3 = 0 or cast(review_id as bigint) % 2 = 0""")
check("m4_upsert_review_days", "engagement", f"""
    select coalesce(n.game_id, o.game_id) as game_id, coalesce(n.date, o.date) as date, {", ".join(f"o.{c}" for c in _SNAPSHOT)},
           case when n.game_id is null then o.reviews_posted else n.r end as reviews_posted,
           case when n.game_id is null then o.reviews_positive_share else 0.5 end as reviews_positive_share, cast(null as bigint) as ingested_at
    from o full join n on o.game_id = n.game_id and o.date = n.date""",
      o=_OLD_DAYS, n="select game_id, date, coalesce(reviews_posted, 0) * 2 as r from engagement where day(date) % 3 = 0 or day(date) % 2 = 0")
check("m5_upsert_estimates", "estimates", """
    select game_id, snapshot_date, est_owners_low, est_owners_high, est_units_lifetime,
           est_revenue_lifetime_usd * case when day(snapshot_date) % 3 = 0 or day(snapshot_date) % 2 = 0 then 2 else 1 end as est_revenue_lifetime_usd, est_source
    from estimates""")

# ---- column expressions --------------------------------------------------------------------------------------

check("p1_slugify", "", """
    select p_partkey, trim(regexp_replace(lower(' ' || p_name || '!! ''' || p_brand || ''' '), '[^a-z0-9]+', '-', 'g'), '-') as slug,
           'unknown' as blank from part""")
check("p2_release_year", "", """
    select o_orderkey, case when o_orderkey % 6 < 5 then cast(year(o_orderdate) as int) end as release_year from orders""")
check("p3_price_cents", "store_all", "select appid, is_free, price_cents from store_all")
check("p4_genres", "store_all", "select appid, primary_genre, genre_list from store_all")
check("p5_platform_flags", "store_all", "select appid, supports_windows, supports_mac, supports_linux from store_all")
check("p6_unwrap_envelope", "store_all", "select appid, name from store_all union all select appid, name from store_all")
check("p7_parse_object", "snaps", """
    select source, count(*) filter (where source = 'twitch_helix' and not broken and k % 17 <> 0) as viewers,
           count(*) filter (where source = 'wikipedia_pageviews' and not broken and k % 19 <> 0) as views,
           count(*) filter (where source = 'google_trends' and not broken) as trends
    from snaps group by source""")
check("p8_owner_range", "est_rows", """
    select entity_key, day as extract_date, case when k % 19 <> 0 then low end as low, case when k % 19 <> 0 then low * 2 end as high
    from est_rows where tiers""")
check("p9_week_start", "", "select o_orderkey, cast(cast(date_trunc('week', o_orderdate) as date) as varchar) as week from orders")
check("p10_month_start", "", "select o_orderkey, cast(cast(date_trunc('month', o_orderdate) as date) as varchar) as month from orders")
check("p11_epoch_day", "reviews", "select review_id, cast(epoch_ms(review_ts * 1000) as date) as day from reviews")
check("p12_quarter_start", "", "select o_orderkey, cast(date_trunc('quarter', o_orderdate) as date) as quarter from orders")
check("p13_strict_types", "vals", """
    select entity_key as game_id, count(viewers) as viewers, count(players) as players, count(views) as views, count(idx) as index_values
    from vals where day is not null group by entity_key""")
check("p14_range_guards", "vals", """
    select entity_key as game_id, min(viewers) as viewers, min(players) as players, min(subscribers) as subscribers, min(posts) as posts
    from vals where day is not null group by entity_key""")
check("p15_appid_key", "est_rows", """
    select entity_key, 1704067200 + k as ingested_at, cast(try_cast(entity_key as bigint) as varchar) as appid from est_rows""")
check("p16_rounding", "", f"""
    select l_orderkey, l_linenumber, l_partkey, {even("l_extendedprice * l_discount", 2)} as two,
           {even("l_extendedprice * l_discount / 7", 4)} as four, cast(round_even(l_quantity / 2, 0) as bigint) as whole
    from lineitem""")
check("p17_safe_ratio", "", "select l_orderkey, l_linenumber, l_partkey, l_quantity / nullif(l_discount, 0) as ratio from lineitem")
check("p18_sql_scalars", "", f"""
    select o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'pending') as status,
           case when o_totalprice >= 100000 or o_orderpriority in ('1-URGENT', '2-HIGH') then 'big' else 'small' end as kind,
           cast(len(string_split(o_orderpriority, '-')) as int) as parts, {half_up("o_totalprice / 1000", 1)} as thousands,
           cast(cast(o_orderdate as date) - interval 35 day as date) as earlier,
           o_orderdate is not null and cast(o_orderdate as date) >= date '1996-01-01' as recent
    from orders""")

# ---- landing shapes ------------------------------------------------------------------------------------------

check("r1_stream_summary", "streams", """
    select category, poll, cast(coalesce(sum(viewer_count) filter (where viewer_count >= 0), 0) as bigint) as viewers,
           count(*) filter (where viewer_count >= 0) as channels,
           coalesce(max(viewer_count) filter (where viewer_count >= 0), 0) as peak_stream_viewers
    from streams group by category, poll""")
check("r2_capped_streams", "streams", """
    select category, cast(coalesce(sum(viewer_count) filter (where viewer_count >= 0), 0) as bigint) as viewers,
           count(*) filter (where viewer_count >= 0) as channels,
           coalesce(max(viewer_count) filter (where viewer_count >= 0), 0) as peak_stream_viewers, false as truncated
    from streams group by category""")
check("r3_posts_of_day", "posts", """
    select c.community, count(*) filter (where cast(epoch_ms(created_utc * 1000) as date) = date '2024-01-03') as posts_today
    from (select distinct community from posts union select 'n' || n_nationkey from nation) c
    left join posts r on r.community = c.community
    group by c.community""")
check("r4_unpack_pageviews", "", """
    select 'art_' || conv_id as article, cast(date '2024-01-01' + cast(turn + conv_id % 20 as int) as date) as date,
           cast(length(text) as bigint) as views
    from conversations where not (turn = 3 and conv_id % 2 = 0) and not (turn = 2 and conv_id % 3 = 0)""")
check("r5_anchor_rescale", "terms anchor", f"""
    select term, week, {even("t.value / a.value * 100", 2)} as trends_index from terms t join anchor a using (week) where a.value <> 0""")
check("r6_week_to_days", "terms", """
    select term, value, cast(week + d.n as date) as date from terms, (values (0), (1), (2), (3), (4), (5), (6)) as d(n)
    where week + d.n <= date '2024-01-25'""")
check("r7_date_review_pages", "", """
    select appid, page, extract_date from p where not vacant""",
      p="""select cast(conv_id as varchar) as appid, turn as page, turn = 4 and conv_id % 4 = 0 as vacant,
                  cast(epoch_ms((1577836800 - turn * 86400 + conv_id % 9 * 86400) * 1000) as date) as extract_date
           from conversations""")
check("r8_unpack_keyed", "", """
    select conv_id, cast(rn - 1 as int) as position, 'k' || (9 - turn) as key, '{"k' || (9 - turn) || '":{"n":' || n || '}}' as payload
    from (select conv_id, turn, length(text) as n, row_number() over (partition by conv_id order by turn) as rn from conversations) c""")
check("r9_unresolved_keys", "snaps xwalk", """
    select source, entity_key, 'no data' as problem from xwalk where (source, entity_key) not in (select (source, entity_key) from snaps)
    union all
    select distinct source, entity_key, 'not tracked' from snaps where (source, entity_key) not in (select (source, entity_key) from xwalk)""")

# ---- raw to typed tables -------------------------------------------------------------------------------------

_STORE = """appid, name, cast(release_year as int) as release_year, is_free, price_cents, supports_windows, supports_mac, supports_linux,
            primary_genre, genre_list, ingested_at"""
check("j1_store_titles", "store_all", f"select {_STORE} from store_all")
check("j2_latest_store_titles", "store", f"select {_STORE} from store")
check("j3_title_dimension", "dim", "select * from dim")
check("j4_stamp_titles", "dim", """
    select game_id, case when steam_appid is not null then 'steam_store' else 'seed_titles' end as source, cast(1767225600 as bigint) as ingested_at from dim""")
check("j5_crosswalk", "xwalk", "select * from xwalk")
check("j5_resolve_titles", "snaps xwalk", """
    select s.source, c.game_id, cast(floor(epoch(ts)) as bigint) as ingested_at from snaps s join xwalk c using (source, entity_key)
    join events e using (event_id)""")
check("j6_stream_viewers", "daily", """
    select game_id, date, twitch_avg_viewers, twitch_peak_viewers, twitch_avg_channels from daily where twitch_peak_viewers is not null""")
check("j7_concurrent_players", "daily", "select game_id, date, steam_ccu_peak from daily where steam_ccu_peak is not null")
check("j8_pageviews", "daily", "select game_id, date, wiki_pageviews from daily where wiki_pageviews is not null")
check("j9_search_index", "daily", "select game_id, date, trends_index from daily where trends_index is not null")
check("j10_community", "daily", """
    select game_id, date, reddit_subscribers, reddit_posts from daily where coalesce(reddit_subscribers, reddit_posts) is not null""")
check("j11_engagement_daily", "daily", "select * from daily")
check("j12_explode_reviews", "page_reviews", """
    select cast(conv_id as varchar) as entity_key, review_id, review_ts, voted_up, playtime_at_review_min, language, received_free
    from page_reviews""")
check("j13_reviews", "page_reviews xwalk", """
    select game_id, review_id, review_ts, voted_up, playtime_at_review_min, language, received_free
    from (select *, row_number() over (partition by review_id order by conv_id desc) as rn
          from page_reviews r join xwalk c on c.source = 'steam_reviews' and c.entity_key = cast(r.conv_id as varchar)
          where review_ts >= 1577836800) d where rn = 1""")
check("j14_reviews_daily", "reviews", f"""
    select game_id, cast(epoch_ms(review_ts * 1000) as date) as date, count(*) as reviews_posted,
           {even("count(*) filter (where voted_up) / count(*)", 4)} as reviews_positive_share
    from reviews group by game_id, cast(epoch_ms(review_ts * 1000) as date)""")
check("j15_owner_tiers", "est_parsed", """
    select entity_key, day as extract_date, est_owners_low, est_owners_high, est_source from est_parsed where tiers""")
check("j16_modelled_sales", "est_parsed", """
    select entity_key, 1704067200 + k as ingested_at, est_units_lifetime, est_revenue_lifetime_usd, est_source from est_parsed where not tiers""")
check("j17_estimates", "est_parsed xwalk", """
    select game_id, day as snapshot_date, est_owners_low, est_owners_high, est_units_lifetime, est_revenue_lifetime_usd, est_source
    from (select p.*, c.game_id, row_number() over (partition by c.game_id, day, est_source order by k desc) as rn
          from est_parsed p join xwalk c on c.entity_key = p.entity_key
               and c.source = case when tiers then 'steamspy_snapshot' else 'gamalytic' end) d where rn = 1""")

# ---- derived tables ------------------------------------------------------------------------------------------

check("g1_platform_trends", "platforms", "select * from platforms")
check("g2_genre_trends", "genres", "select * from genres")
check("g3_weekly_rollup", "weekly", "select * from weekly")
check("g4_signal_indices", "attention", "select game_id, week, twitch_idx, wiki_idx, trends_idx, reddit_idx from attention")
check("g5_attention_index", "attention", "select game_id, week, attention_index from attention")
check("g6_attention_trends", "attention", "select * from attention")
check("g7_cohort_split", "cohorts", "select * from cohorts")
check("g8_top_titles", "top20", "select * from top20")
check("g9_monthly_viewers", "months", f"select game_id, month, {even('viewers', 2)} as twitch_avg_viewers from months")
check("g10_monthly_rank", "ranked", "select game_id, month, cast(rank as int) as rank from ranked")
check("g11_rank_movement", "ranked", "select game_id, month, cast(rank_delta as int) as rank_delta from ranked")
check("g12_monthly_reviews", "months", "select game_id, month, reviews_posted from months")
check("g13_latest_estimates", "newest", "select * from newest")
check("g13_title_monthly", "monthly", "select * from monthly")
check("g14_revenue_engagement", "revenue", "select * from revenue")

# ---- questions -----------------------------------------------------------------------------------------------

check("q1_top_genres", "genres", """
    select primary_genre, title_count from genres where release_year = (select max(release_year) from genres)
    order by title_count desc, primary_genre limit 5""")
check("q2_price_free_and_paid", "catalogue", f"""
    select release_year, {half_up("sum(price_cents) filter (where is_free) / count(price_cents) filter (where is_free) / 100", 2)} as avg_price_free_usd,
           {half_up("sum(price_cents) filter (where not is_free) / count(price_cents) filter (where not is_free) / 100", 2)} as avg_price_paid_usd,
           count(*) as titles
    from catalogue where release_year is not null group by release_year""")
check("q2_price_indie_and_other", "catalogue", f"""
    select release_year,
           {half_up("sum(price_cents) filter (where primary_genre = '2-HIGH') / count(price_cents) filter (where primary_genre = '2-HIGH') / 100", 2)} as avg_price_indie_usd,
           {half_up("sum(price_cents) filter (where primary_genre is distinct from '2-HIGH') / count(price_cents) filter (where primary_genre is distinct from '2-HIGH') / 100", 2)} as avg_price_other_usd,
           count(*) as titles
    from catalogue where release_year is not null group by release_year""")
check("q3_platform_share_change", "platforms", f"""
    select platform, {half_up("max(share) filter (where release_year = 2000) - max(share) filter (where release_year = 1996)", 4)} as share_delta
    from (select *, title_count / sum(title_count) over (partition by release_year) as share from platforms) s
    where release_year in (1996, 2000) group by platform""")
check("q4_free_genre_mix", "catalogue", f"""
    select primary_genre, count(*) as titles, {half_up("count(*) / (select count(*) from catalogue where is_free)", 4)} as share
    from catalogue where is_free group by primary_genre""")
check("q5_peak_year", "platforms", """
    select release_year, title_count from platforms where platform = 'linux' order by title_count desc, release_year limit 1""")
check("q6_yearly_change", "genres", """
    select a.release_year, a.title_count, a.title_count - (
        select b.title_count from genres b where b.primary_genre = '1-URGENT' and b.release_year < a.release_year
        order by b.release_year desc limit 1) as yoy_change
    from genres a where a.primary_genre = '1-URGENT'""")
check("q7_quarterly_viewer_share", "cohorts", f"""
    select cast(date_trunc('quarter', cast(week as date)) as date) as quarter, cohort,
           {half_up(mean("twitch_viewer_share"), 4)} as avg_twitch_viewer_share
    from cohorts group by cast(date_trunc('quarter', cast(week as date)) as date), cohort""")
check("q8_off_store_above_store", "monthly dimension", """
    select game_id, twitch_avg_viewers, rank from r
    where not on_steam and rank < (select min(rank) from r where on_steam)""",
      r="select m.*, not d.on_steam as on_steam from monthly m join dimension d using (game_id) where month = (select max(month) from monthly)")
check("q9_attention_of", "attention", """
    select week, attention_index, twitch_idx, wiki_idx, trends_idx, reddit_idx from attention
    where game_id = 'supplier-000000007' and week >= '1999-01-01'""")
check("q10_biggest_spikes", "attention", """
    select game_id, week, attention_index, attention_wow_delta from attention where week >= '2001-05-27'
    order by attention_wow_delta desc nulls last, game_id, week limit 10""")
check("q11_revenue_per_viewer", "revenue dimension", f"""
    select d.is_free, {half_up(mean("revenue_per_avg_viewer"), 2)} as avg_revenue_per_viewer,
           count(distinct r.game_id) as titles
    from revenue r join dimension d using (game_id) where revenue_per_avg_viewer is not null group by d.is_free""")

# ---- reports -------------------------------------------------------------------------------------------------

check("d1_rows_per_source", "snaps", "select source, count(*) as n from snaps group by source")
check("d2_titles_per_cohort", "dimension", "select on_steam, count(*) as titles from dimension group by on_steam")
check("d3_signal_coverage", "engagement", """
    select date, count(*) as titles, count(twitch_avg_viewers) as with_twitch, count(steam_ccu_peak) as with_ccu,
           count(wiki_pageviews) as with_wiki, count(trends_index) as with_trends, count(reddit_subscribers) as with_reddit
    from engagement group by date order by date desc limit 14""")
check("d4_snapshots_per_source", "estimates", "select est_source, count(*) as snapshots from estimates group by est_source")
check("d5_seed_report", "seed", """
    select count(*) as seed_rows, cast(count(*) - count(distinct game_id) as bigint) as repeated_game_ids,
           count(*) filter (where storefronts = '') as without_storefront, count(*) filter (where steam_appid is null) as off_store_rows,
           count(*) filter (where game_id <> trim(regexp_replace(lower(game_id), '[^a-z0-9]+', '-', 'g'), '-')) as not_slug_shaped,
           cast(count(steam_appid) - count(distinct steam_appid) as bigint) as repeated_appids,
           count(*) >= 30 and count(*) filter (where steam_appid is null) >= 5 and count(*) filter (where storefronts = '') = 0 as usable
    from seed""")
check("d6_share_sums", "genres", f"""
    select release_year, {total("release_share")} as share_sum, abs({total("release_share")} - 1) <= 0.001 as balanced
    from genres group by release_year""")
check("d7_platforms_in_order", "platforms", "select * from platforms order by release_year, platform")
check("d7_genres_in_order", "genres", "select * from genres order by release_year, release_share desc, primary_genre")
check("d7_first_attention_rows", "attention", "select * from attention order by game_id, week limit 10")
check("d7_cohorts_in_order", "cohorts", "select * from cohorts order by week, cohort")
check("d7_leaders", "monthly", "select * from monthly order by month, rank nulls last limit 20")
check("d7_best_revenue_ratios", "revenue", "select * from revenue order by revenue_per_avg_viewer desc nulls last, game_id, month limit 20")

# ---- the same rows by another way ------------------------------------------------------------------------------

for _name, _same in {
    "m2_merge_in_parts": "m2_upsert_engagement", "m3_merge_in_parts": "m3_upsert_reviews",
    "j11_engagement_by_batches": "j11_engagement_daily", "j13_reviews_by_batches": "j13_reviews",
}.items():
    CHECKS[_name] = CHECKS[_same]
