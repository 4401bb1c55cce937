"""Request panels over events and counters."""

from __future__ import annotations

from tidemart.operators import monitoring
from tidemart.plans.check_sql import rnd, with_views
from tidemart.plans.derived import HOT_HANDLER_ROWS
from tidemart.plans.registry import query


def _rate_sql(where="true"):
    return f"""
        select handler, date_trunc('minute', ts) as window_start,
          date_trunc('minute', ts) + interval 1 minute as window_end,
          count(*) as requests, {rnd("count(*) / 60", 6)} as per_second
        from http_requests where {where} group by all"""


def _flat(df):
    return df.withColumns({
        c: df[c].cast("timestamp_ntz") for c in ("window_start", "window_end")
    })


@query("m1_request_rate", with_views(_rate_sql()))
def _(t):
    return _flat(monitoring.request_rate(t.http_requests()))


@query("m1_sliding_request_rate", with_views(f"""
    select handler, window_start, window_start + interval 1 minute as window_end,
      count(*) as requests, {rnd("count(*) / 60", 6)} as per_second
    from (select handler, unnest([0, 15, 30, 45]) as back,
            time_bucket(interval 15 second, ts) - back * interval 1 second as window_start
          from http_requests)
    group by handler, window_start"""))
def _(t):
    rates = monitoring.request_rate(t.http_requests(), slide=monitoring.SCRAPE_INTERVAL)
    return _flat(rates)


@query("m1_counter_rate", with_views(f"""
    select handler, date_trunc('minute', ts) as window_start,
      date_trunc('minute', ts) + interval 1 minute as window_end,
      cast(sum(increase) as double) as increase,
      {rnd("sum(increase) / 60", 6)} as per_second
    from increases group by all"""))
def _(t):
    rates = _flat(monitoring.counter_rate(
        t.http_counters(), ["handler"], hot_rows=HOT_HANDLER_ROWS
    ))
    return rates.withColumn("increase", rates.increase.cast("double"))


@query("m2_mean_duration", with_views(f"""
    select handler, date_trunc('minute', ts) as window_start,
      date_trunc('minute', ts) + interval 1 minute as window_end, count(*) as requests,
      {rnd("sum(duration) / count(*)", 6)} as mean_duration
    from http_requests group by all"""))
def _(t):
    return _flat(monitoring.mean_duration(t.http_requests()))


@query("m3_server_error_rate", with_views(_rate_sql("status like '5__'")))
def _(t):
    return _flat(monitoring.error_rate(t.http_requests(), 5))


@query("m4_client_error_rate", with_views(_rate_sql("status like '4__'")))
def _(t):
    return _flat(monitoring.error_rate(t.http_requests(), 4))


@query("m5_counter_increase", with_views("""
    select handler, ts, value, cast(increase as double) as increase from increases"""))
def _(t):
    found = monitoring.counter_increase(
        t.http_counters(), ["handler"], hot_rows=HOT_HANDLER_ROWS
    )
    return found.withColumn("increase", found.increase.cast("double"))
