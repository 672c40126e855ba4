from oracle.texts import day, mean, ratio

BARS = """
bars as (
    select *,
           close_price - open_price as daily_change,
           high_price - low_price as daily_range
    from (
        select p_brand as symbol,
               cast(l_shipdate as date) as trade_date,
               arg_min(price, k) as open_price,
               max(price) as high_price,
               min(price) as low_price,
               arg_max(price, k) as close_price,
               cast(sum(cast(l_quantity as bigint)) as bigint) as volume
        from (select l_partkey, l_shipdate, l_quantity,
                     cast(l_extendedprice as decimal(12,4)) as price,
                     row(l_orderkey, l_linenumber, l_partkey, l_suppkey) as k
              from lineitem) l
        join part on l_partkey = p_partkey
        group by 1, 2
    )
)
"""


def _dbl(*columns: str) -> str:
    return ", ".join(f"cast({c} as double) as {c}" for c in columns)


def _size(n: str) -> str:
    """Size text by repeated halving of the next unit."""
    h = [f"(({n}) // {2 ** (10 * p - 1)})" for p in range(1, 6)]
    out = f"case when {n} < 10240 then ({n}) || ' bytes'"
    for half, name in zip(h, ["kB", "MB", "GB", "TB"]):
        out += f" when {half} < 20479 then (({half} + 1) // 2) || ' {name}'"
    return out + f" else (({h[4]} + 1) // 2) || ' PB' end"


PRICES = _dbl("open_price", "high_price", "low_price", "close_price")

_YEARS = f"""
with {BARS}, years as (
    select cast(year(trade_date) as int) as yil, count(*) as kayit_sayisi, count(distinct symbol) as farkli_hisse
    from bars group by 1
)
select yil, kayit_sayisi, farkli_hisse,
       {ratio("kayit_sayisi * 100", "(select count(*) from bars)", 2)} as yuzdesi,
       {_size("kayit_sayisi * 100")} as tahmini_alan
from years
"""


def _returns(weighted: bool) -> str:
    return f"""
with {BARS}, daily as (
    select symbol, year(trade_date) as yil,
           first_value(close_price) over (partition by symbol, year(trade_date) order by trade_date, close_price) as f,
           last_value(close_price) over (partition by symbol, year(trade_date) order by trade_date, close_price
               rows between unbounded preceding and unbounded following) as l
    from bars
), per_row as (
    select {"" if weighted else "distinct"} symbol, yil,
           cast({ratio("cast((l - f) * 10000 as bigint) * 100", "cast(f * 10000 as bigint)", 8)} * 100000000 as bigint) as r
    from daily
)
select symbol, {ratio("sum(r)", "count(r) * 100000000", 2)} as ort_yillik_getiri_pct
from per_row group by symbol having count(distinct yil) >= 4
order by ort_yillik_getiri_pct desc, symbol limit 15
"""


_PEAK_ALL = f"""
with {BARS}
select symbol, {day("trade_date")} as trade_date, {_dbl("close_price")},
       cast((select max(p.close_price) from bars p where p.symbol = b.symbol) as double) as tum_zamanin_zirve_fiyati
from bars b where trade_date = date '1999-01-04'
"""

_MEANS = f"""
with {BARS}
select symbol, {day("trade_date")} as trade_date, {_dbl("close_price")},
  {mean("close_price", 4, 4, "over (partition by symbol order by trade_date rows between 19 preceding and current row)")} as hareketli_ort_20g,
  {mean("close_price", 4, 4, "over (partition by symbol order by trade_date rows between 49 preceding and current row)")} as hareketli_ort_50g
from bars
"""

_TOP_AVG = f"""
with {BARS}
select symbol, {mean("close_price", 4, 8)} as ort_kapanis from bars
where trade_date between date '2000-01-01' and date '2000-12-31'
group by symbol order by ort_kapanis desc, symbol limit 10
"""

_FULL = f"""
with {BARS}
select symbol, {day("trade_date")} as trade_date, {PRICES}, volume, {_dbl("daily_change", "daily_range")}
from bars
"""

SQL = {
    "ingest_bars": _FULL,
    "ingest_bar_files": _FULL,
    "bar_derived": f"with {BARS} select symbol, {day('trade_date')} as trade_date, {_dbl('daily_change', 'daily_range')} from bars",
    "bars_range_scan": f"""
with {BARS}
select symbol, {day("trade_date")} as trade_date, {PRICES}, volume
from bars where symbol = 'Brand#13' and trade_date between date '1997-01-01' and date '1998-12-31'
""",
    "bars_range_scan_narrow": f"""
with {BARS}
select symbol, {day("trade_date")} as trade_date, {_dbl("close_price")}
from bars where symbol = 'Brand#13' and trade_date between date '1997-01-01' and date '1998-12-31'
""",
    "peak_all_time": _PEAK_ALL,
    "peak_correlated": _PEAK_ALL + " order by symbol limit 10",
    "peak_same_day": f"""
with {BARS}
select distinct symbol, {day("trade_date")} as trade_date, {_dbl("close_price")},
       cast(max(close_price) over (partition by symbol) as double) as tum_zamanin_zirve_fiyati
from bars where trade_date = date '1999-01-04'
""",
    "yearly_stats": f"""
with {BARS}
select symbol, cast(year(trade_date) as int) as yil, count(*) as islem_gunu,
       {mean("close_price", 4, 2)} as ort_kapanis,
       cast(min(low_price) as double) as yillik_dip, cast(max(high_price) as double) as yillik_zirve,
       cast(sum(volume) as bigint) as toplam_hacim
from bars where symbol in ('Brand#1', 'Brand#7', 'Brand#13', 'Brand#19', 'Brand#25') group by 1, 2
""",
    "top_movers_daily": f"""
with {BARS}, ranked as (
    select trade_date, symbol, daily_change,
           {ratio("cast(daily_change * 10000 as bigint) * 100", "cast(open_price * 10000 as bigint)", 2)} as degisim_yuzdesi,
           cast(rank() over (partition by trade_date order by daily_change desc) as int) as siralama
    from bars where trade_date >= date '2000-01-01' and volume > 50
)
select {day("trade_date")} as trade_date, symbol, {_dbl("daily_change")}, degisim_yuzdesi, siralama
from ranked where siralama <= 5 order by ranked.trade_date desc, siralama, symbol limit 50
""",
    "top_movers_daily_all": f"""
with {BARS}, ranked as (
    select trade_date, symbol, daily_change,
           {ratio("cast(daily_change * 10000 as bigint) * 100", "cast(open_price * 10000 as bigint)", 2)} as degisim_yuzdesi,
           cast(rank() over (partition by trade_date order by daily_change desc) as int) as siralama
    from bars where volume > 50
)
select {day("trade_date")} as trade_date, symbol, {_dbl("daily_change")}, degisim_yuzdesi, siralama
from ranked where siralama <= 5
""",
    "moving_averages": f"select * exclude (symbol) from ({_MEANS}) where symbol = 'Brand#13' order by trade_date limit 100",
    "moving_averages_all": _MEANS,
    "top_avg_close": _TOP_AVG,
    "top_avg_close_pruned": _TOP_AVG,
    "year_share": _YEARS,
    "year_share_subquery": _YEARS,
    "top_volume": f"""
with {BARS}
select symbol, cast(sum(volume) as bigint) as toplam_hacim, {mean("close_price", 4, 2)} as ort_kapanis, count(*) as islem_gunu
from bars group by symbol order by toplam_hacim desc, symbol limit 10
""",
    "avg_yearly_return": _returns(True),
    "avg_yearly_return_equal": _returns(False),
    "load_summary": f"""
with {BARS}
select count(*) as toplam_kayit, count(distinct symbol) as farkli_hisse,
       {day("min(trade_date)")} as ilk_tarih, {day("max(trade_date)")} as son_tarih
from bars
""",
    "bars_by_year": f"select *, cast(left(trade_date, 4) as int) as trade_year from ({_FULL})",
    "replaced_year": f"""
with {BARS}
select cast(year(trade_date) as int) as trade_year, symbol, count(*) as satir_sayisi, cast(sum(volume) as bigint) as hacim
from bars where year(trade_date) <> 1996 or volume > 50 group by all
""",
    "load_times": f"""
with {BARS}
select symbol, {day("trade_date")} as trade_date, '2024-01-31 12:30:15.250000' as created_at, 'stocks_etl' as username from bars
""",
    "partition_inventory": f"with {BARS} select cast(year(trade_date) as int) as trade_year, count(*) as satir_sayisi from bars group by 1",
    "layout_comparison": f"""
with {BARS}, n as (
    select count(*) as n from bars where symbol = 'Brand#13' and trade_date between date '1997-01-01' and date '1997-12-31'
)
select 'plain' as test_tipi, n as satir_sayisi from n union all select 'by year', n from n
""",
    "explain_analyze": f"""
with {BARS}, scanned as (select * from bars where year(trade_date) in (1996, 1997)),
     picked as (select * from scanned where 2 * daily_change > daily_range)
select 'Scan' as operator, count(*) as rows_out, count(distinct year(trade_date)) as folders_read, true as has_files from scanned
union all select 'Filter', count(*), null, null from picked
union all select 'HashAggregate', count(distinct symbol), null, null from picked
""",
    "stream_bars": f"""
with {BARS}
select symbol, {day("trade_date")} as trade_date, {PRICES}, volume, {_dbl("daily_change")}, null as reason
from bars where year(trade_date) between 1993 and 1997
union all
select symbol, {day("trade_date")}, null, null, null, null, null, null, 'trade_date: no partition'
from bars where year(trade_date) not between 1993 and 1997
""",
    "clustered_reads": f"""
with {BARS}, c as (
    select symbol = 'Brand#13' as s, trade_date between date '1997-03-01' and date '1997-06-30' as d from bars
)
select unnest(['symbol', 'days', 'both', 'all']) as filtre, true as few_files,
       unnest([count_if(s), count_if(d), count_if(s and d), count(*)]) as satir_sayisi
from c
""",
    "timed_queries": f"""
with {BARS}
select 'sorted' as test_tipi, count(*) as satir_sayisi, true as timed from bars
union all
select 'yearly', count(distinct (symbol, year(trade_date))), true
from bars where symbol in ('Brand#1', 'Brand#7', 'Brand#13', 'Brand#19', 'Brand#25')
""",
}

# The bars as they are after a load that halves the prices of some days.
_HALVED = ", ".join(
    f"case when day(trade_date) = 15 and symbol not like '%3' then cast({p} * 0.5 as decimal(12,4)) else {p} end as {p}"
    for p in ("open_price", "high_price", "low_price", "close_price")
)
CORRECTED = BARS.replace("bars as (", "first_bars as (") + f", bars as (select symbol, trade_date, {_HALVED}, volume from first_bars)"
SQL |= {f"{key}_from_states": SQL[key].replace(BARS, CORRECTED) for key in ("yearly_stats", "avg_yearly_return", "load_summary")}
# means of arriving bars are those of all bars
SQL["stream_means"] = SQL["moving_averages_all"]
