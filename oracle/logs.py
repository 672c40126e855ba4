from oracle.texts import day, mean, ratio, stamp

LOG = """
qlog as (
    select event_id as id, ts as logged_at, 'user_' || user_id as username,
           'SELECT ' || event_type || ' WHERE ' || props as query_text,
           cast(value as decimal(10,3)) as duration_ms, user_id % 50 as rows_returned, event_type as notes
    from events
)
"""

_TOTAL = "cast(sum(cast(duration_ms * 1000 as bigint)) as hugeint)"
# two-decimal values, so rounding to two places changes nothing in the totals
_STATEMENTS = f"""
{LOG}, st as (
    select query_text, count(*) as n, sum(duration_ms) as total, {_TOTAL} as total_units, count(duration_ms) as timed,
           min(duration_ms) as lo, max(duration_ms) as hi, cast(sum(rows_returned) as bigint) as toplam_satir
    from qlog where query_text ilike '$P' group by query_text
)
"""

SQL = {
    "slow_statements": f"""
with {_STATEMENTS.replace("$P", "%where%7%")}
select left(query_text, 100) as sorgu_ozeti, n as cagri_sayisi, round(cast(total as double), 2) as toplam_sure_ms,
       {ratio("total_units", "timed * 1000", 2)} as ortalama_sure_ms, cast(lo as double) as min_sure_ms,
       cast(hi as double) as max_sure_ms, toplam_satir
from st order by {ratio("total_units", "timed * 1000", 8)} desc, query_text limit 20
""",
    "rows_per_call": f"""
with {_STATEMENTS.replace("$P", "%")}
select query_text, n as cagri_sayisi, toplam_satir, {ratio("toplam_satir", "n", 1)} as cagri_basina_satir,
       {ratio("toplam_satir * 1000", "total_units", 2)} as ms_basina_satir
from st
""",
    "latest_log": f"""
with {LOG}
select notes as test_tipi, cast(duration_ms as double) as sure_ms, rows_returned as satir_sayisi, {stamp("logged_at")} as test_zamani
from qlog order by qlog.logged_at desc, id desc limit 10
""",
    "statement_ages": f"""
with {LOG}
select id as pid, username as kullanici, notes as durum,
       {ratio("date_diff('microsecond', logged_at, timestamp '2024-02-01 00:00:00')", "1000000", 2)} as sure_saniye,
       left(query_text, 120) as sorgu
from qlog where notes <> 'signup' and query_text not ilike '%VIEW%'
""",
    "usage_bands": """
with n as (select c_custkey, count(event_id) as n from customer left join events on c_custkey = user_id group by 1)
select c_custkey, n as kullanim_sayisi,
       case when n = 0 then 'KALDIR - Hic kullanilmamis' when n < 10 then 'GOZDEN GECIR - Az kullaniliyor'
            else 'Aktif - Koru' end as oneri,
       case when n = 0 then 'KULLANIMIYOR - Kaldir!' else 'Aktif' end as durum
from n
""",
    "pairs_in_group": """
select s_nationkey, count(*) as uye_sayisi, min(s_suppkey) as ilk_uye, max(s_suppkey) as son_uye,
       cast(count(*) * (count(*) - 1) // 2 as bigint) as cift_sayisi, 'Indeks_1 Indeks_2 ile kapsaniyor olabilir' as uyari
from supplier group by 1 having count(*) > 1
""",
    "later_partners": """
select c_nationkey, c_custkey, count(*) over (partition by c_nationkey) - row_number() over (partition by c_nationkey order by c_custkey)
       as sonraki_uye
from customer
""",
}
