"""Check SQL: the lake's tables as common table expressions over the test tables."""

from __future__ import annotations

import re

from tidemart.plans.derived import NEGATIVE_WORDS, POSITIVE_WORDS, TOPIC_STOPWORDS

TOKEN = r"[\p{L}\p{N}_]{2,}"


def words(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def rnd(expr: str, digits: int) -> str:
    """Half-away rounding of the number as it prints, as double, never negative zero."""
    printed = f"cast(cast({expr} as double) as varchar)"
    return f"cast(round(cast({printed} as decimal(38, 18)), {digits}) as double)"


_STARS = ",\n".join(
    f"  count(*) filter (where rating = {s}) as star_{s}_count" for s in (5, 4, 3, 2, 1)
)

# In order of dependence.
VIEWS = {
    "raw_products": """
        select l_partkey as product_id, l_suppkey as shop_id,
          case when l_orderkey % 89 = 0 then '   ' else p_name end as name,
          p_brand as keyword,
          case when l_orderkey % 97 = 0 then -l_extendedprice
               when l_orderkey % 101 = 0 then null else l_extendedprice end as price,
          l_extendedprice / (1 - l_discount) as original_price,
          case when l_orderkey % 83 = 0 then 6.0e0 when l_orderkey % 79 = 0 then null
               else l_quantity / 10 end as rating,
          cast(l_quantity as bigint) as sold_count, cast(p_size as bigint) as category_id,
          n_name as shop_location, l_shipdate as scraped_at,
          l_orderkey, l_linenumber, l_quantity
        from lineitem join part on l_partkey = p_partkey
          join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey""",
    "single_products": """
        select * from raw_products
        qualify row_number() over (partition by product_id, scraped_at order by l_orderkey,
          l_linenumber, shop_id, price nulls first, l_quantity) = 1""",
    "clean_products": """
        select * replace (cast(trunc(price) as bigint) as price) from single_products""",
    "silver_products": """
        select * from clean_products
        where product_id is not null and price > 0 and length(trim(name, ' ')) > 0
          and (rating is null or rating between 0 and 5)""",
    "raw_reviews": """
        select * from (
          select e.event_id as review_id,
            (e.event_id * 7919) % (select count(*) from part) as product_id,
            case when e.event_id % 53 = 0 then 0 when e.event_id % 59 = 0 then null
                 else cast(1 + cast(floor(value) as bigint) % 5 as int) end as rating,
            event_type as review_text, ts as created_at
          from events e)
        where product_id % 5 <> 0""",
    "silver_reviews": """
        select * from raw_reviews where review_id is not null and product_id is not null
          and rating between 1 and 5""",
    "review_aggregate": f"""
        select product_id, count(review_id) as total_reviews,
          {rnd("avg(rating)", 2)} as avg_rating,
          {_STARS}
        from silver_reviews group by product_id""",
    "latest_snapshot": """
        select * from silver_products
        qualify row_number() over (partition by product_id order by scraped_at desc) = 1""",
    "product_metrics": f"""
        select p.*, coalesce(total_reviews, 0) as total_reviews,
          coalesce(avg_rating, 0.0) as avg_rating,
          coalesce(star_5_count, 0) as star_5_count,
          coalesce(star_4_count, 0) as star_4_count,
          coalesce(star_3_count, 0) as star_3_count,
          coalesce(star_2_count, 0) as star_2_count,
          coalesce(star_1_count, 0) as star_1_count,
          coalesce({rnd("star_5_count / total_reviews * 100", 2)}, 0.0) as star_5_percentage
        from latest_snapshot p left join review_aggregate r on p.product_id = r.product_id""",
    "lagged": """
        select *, lag(price) over w as previous_price,
          lag(scraped_at) over w as previous_scraped_at
        from silver_products
        window w as (partition by product_id order by scraped_at)""",
    "price_history": f"""
        select *, cast(scraped_at as date) as scraped_date,
          price - previous_price as price_change_abs,
          case when previous_price > 0 then
            {rnd("(price - previous_price) / previous_price * 100", 2)} end as price_change_pct,
          date_diff('day', previous_scraped_at, scraped_at) as days_since_last_seen,
          price - previous_price > 0 as is_price_increased,
          price - previous_price < 0 as is_price_decreased,
          coalesce({rnd("(price - previous_price) / previous_price * 100", 2)} <= -15
            and abs(price - previous_price) >= 20000, false) as is_discount_suspicious
        from lagged""",
    "review_texts": """
        select doc_id as review_id, doc_id % (select count(*) from part) as product_id,
          text as review_text
        from documents""",
    "clean_texts": r"""
        select review_id, product_id,
          regexp_replace(review_text, '[\n\r]+', ' ', 'g') as review_text
        from review_texts""",
    "token_counts": rf"""
        select *, regexp_extract_all(lower(review_text), '{TOKEN}') as toks from clean_texts""",
    "balances": f"""
        select *, len(list_filter(toks, lambda w: w in ({words(POSITIVE_WORDS)})))
          - len(list_filter(toks, lambda w: w in ({words(NEGATIVE_WORDS)}))) as balance
        from token_counts""",
    "sentiments": """
        select review_id, product_id, review_text,
          case when balance > 0 then 'positive' when balance < 0 then 'negative'
               else 'neutral' end as sentiment_label,
          case when balance > 0 then 1.0e0 when balance < 0 then -1.0e0
               else 0.0e0 end as sentiment_score
        from balances""",
    "negative_words": rf"""
        select review_id, list_filter(
            regexp_extract_all(lower(review_text), '{TOKEN}'),
            lambda w: w not in ({words(TOPIC_STOPWORDS)})) as toks
        from sentiments where sentiment_label = 'negative'""",
    "negative_phrases": """
        select review_id, unnest(list_transform(range(1, len(toks)),
            lambda i: toks[i] || ' ' || toks[i + 1])) as topic
        from negative_words
        union all
        select review_id, unnest(list_transform(range(1, len(toks) - 1),
            lambda i: toks[i] || ' ' || toks[i + 1] || ' ' || toks[i + 2])) as topic
        from negative_words""",
    "phrase_counts": """
        select topic, count(*) as count, count(distinct review_id) as documents
        from negative_phrases group by topic""",
    "negative_topics": """
        select topic, count from phrase_counts where documents >= 2
        order by count desc, topic limit 20""",
    "http_requests": """
        select event_id, ts, event_type as handler, value as duration,
          case event_type when 'error' then '500' when 'signup' then '404'
               else '200' end as status
        from events""",
    "http_counters": """
        select handler, ts, (max(n) - 1) % 500 + 1 as value from (
          select handler, ts,
            row_number() over (partition by handler order by ts, event_id) as n
          from http_requests)
        group by handler, ts""",
    "increases": """
        select handler, ts, value,
          case when value < previous then value else value - previous end as increase
        from (select *, lag(value) over (partition by handler order by ts) as previous
              from http_counters)""",
    "search_responses": """
        select *, case when l_orderkey % 17 = 0 then 'other' else 'search' end as kind,
          case when l_orderkey % 13 = 0 then 403 else 200 end as status
        from raw_products""",
    # A null price is left out of the payload, and an absent price counts as zero.
    "search_items": """
        select *, 1 as slot, coalesce(price * 100000, 0) as sent_price from search_responses
        where kind = 'search' and status = 200
        union all
        select *, 2 as slot, coalesce(price, 0) as sent_price from search_responses
        where kind = 'search' and status = 200""",
    "parsed_products": """
        select *,
          case when sent_price > 1000000 then sent_price / 100000 else sent_price end
            as shown_price,
          case when original_price * 100000 > 1000000
               then original_price * 100000 / 100000 else original_price * 100000 end
            as shown_original
        from search_items""",
    "rating_items": """
        select *, review_id % 100 as shop_id from raw_reviews
        where review_id % 19 <> 0 and review_id % 23 <> 0""",
    "layer_tables": """
        select 'Bronze.Products' as layer, (select count(*) from raw_products) as rows
        union all select 'Silver.Products', (select count(*) from silver_products)
        union all select 'Gold.Metrics', (select count(*) from product_metrics)
        union all select 'Bronze.Reviews', (select count(*) from raw_reviews)
        union all select 'Silver.Reviews', (select count(*) from silver_reviews)
        union all select 'Gold.Sentiment', (select count(*) from sentiments)""",
}


def with_views(body: str) -> str:
    """Prefix a statement with the views it names, directly or through other views."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, definition in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(definition)

    visit(body)
    parts = [f"{name} as ({VIEWS[name]})" for name in VIEWS if name in needed]
    return f"with {', '.join(parts)}\n{body}" if parts else body
