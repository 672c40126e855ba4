from oracle.texts import day

# The booking lines as typed values before faults, and the reason of a fault.
BOOKINGS = """
raw as (
    select o_orderkey as k, o_custkey as g, o_orderdate as d, o_orderstatus as s,
           cast(o_totalprice as decimal(10,2)) as price, n_name, c_mktsegment, c_acctbal,
           case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'City Hotel'
                when o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then 'Resort Hotel' else 'Garden Hotel' end as hotel
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
), reasoned as (
    select *, case when k % 13 = 0 then 'booking_changes: not an integer'
                   when k % 17 = 0 then 'adr: not a number'
                   when k % 29 = 0 then 'hotel: too long'
                   when k % 23 = 0 and k % 31 <> 0 then 'reservation_status_date: not a date' end as reason
    from raw
), good as (
    select k as id, hotel, cast(s = 'F' as int) as is_canceled, cast(k % 400 as int) as lead_time,
           cast(year(d) as int) as arrival_date_year, monthname(d) as arrival_date_month,
           cast(weekofyear(d) as int) as arrival_date_week_number, cast(day(d) as int) as arrival_date_day_of_month,
           cast(k % 3 as int) as stays_in_weekend_nights, cast(k % 5 as int) as stays_in_week_nights,
           cast(k % 2 + 1 as int) as adults,
           cast(case when k % 7 = 0 or k % 11 = 0 then null else k % 4 end as double) as children,
           cast(k % 2 as int) as babies, case when k % 5 = 0 then 'NULL' else 'BB' end as meal,
           case when k % 6 = 0 then 'NULL' when k % 10 = 0 then '' else n_name end as country,
           c_mktsegment as market_segment, 'Direct' as distribution_channel,
           cast(c_acctbal > 0 as int) as is_repeated_guest, cast(k % 2 as int) as previous_cancellations,
           cast(k % 3 as int) as previous_bookings_not_canceled,
           chr(cast(k % 8 + 65 as int)) as reserved_room_type, chr(cast(k % 9 + 65 as int)) as assigned_room_type,
           cast(k % 4 as int) as booking_changes, 'No Deposit' as deposit_type,
           case when k % 7 <> 0 then cast(g as varchar) end as agent,
           case when k % 11 <> 0 and k % 3 <> 0 then cast(g as varchar) end as company,
           cast(k % 20 as int) as days_in_waiting_list,
           case when k % 4 = 0 then 'Group' else 'Transient' end as customer_type,
           cast(case when k % 19 = 0 then price + 0.01 else price end as double) as adr,
           cast(k % 2 as int) as required_car_parking_spaces, cast(k % 6 as int) as total_of_special_requests,
           case when k % 31 = 0 then null when s = 'F' then 'Canceled' else 'Check-Out' end as reservation_status,
           case when k % 31 <> 0 then $DAY end as reservation_status_date
    from reasoned where reason is null
)
""".replace("$DAY", day("d"))

UNCHECKED = """
u as (
    select l_orderkey * 8 + l_linenumber as id, l_partkey as part_id, cast(l_shipdate as date) as trade_date,
           case when l_discount > 0 then l_extendedprice end as open_price,
           case when l_tax > 0 then l_extendedprice end as close_price,
           cast(cast(l_extendedprice as decimal(12,2)) as varchar) || case when l_linenumber = 7 then ' TL' else '' end
               || case when l_linenumber = 6 then 'e6' else '' end as amount,
           repeat(l_returnflag, l_linenumber * 2) as symbol
    from lineitem
)
"""

# Rows of three batches as an insert row by row would judge them.
KEYED = f"""
{UNCHECKED}, judged as (
    select *, cast(id % 3 as int) as batch,
           concat_ws('; ', case when open_price is null then 'open_price: missing' end,
                     case when not coalesce(year(trade_date) between 1993 and 1997, false) then 'trade_date: no partition' end,
                     case when part_id % 10 = 3 then 'part_id: not in parts' end) as faults
    from u
), placed as (
    select *, case when faults = '' then row_number() over (partition by part_id, trade_date, faults = '' order by batch, id, amount) end as place
    from judged
), decided as (
    select *, case when place > 1 then 'part_id, trade_date: key exists' else faults end as reasons from placed
)
"""

SQL = {
    "keyed_accepted": f"with {KEYED} select id, part_id, {day('trade_date')} as trade_date, amount, batch from decided where reasons = ''",
    "keyed_refused": f"with {KEYED} select batch, reasons, count(*) as satir_sayisi from decided where reasons <> '' group by all",
    "ingest_bookings": f"with {BOOKINGS} select * from good",
    "ingest_booking_files": f"with {BOOKINGS} select * exclude (id) from good",
    "appended_loads": f"""
with {BOOKINGS}
select unnest(['kayit', 'numara', 'eslesme']) as ad, 2 * count(*) as sayi from good
""",
    "load_outcomes": f"""
with {BOOKINGS} select coalesce(reason, 'good') as sonuc, count(*) as satir_sayisi from reasoned group by 1
""",
    "serial_ids": f"""
with {UNCHECKED}
select {day("trade_date")} as trade_date, id, part_id, amount,
       row_number() over (order by u.trade_date nulls first, id, part_id, amount) as serial
from u
""",
    "repeated_loads": f"""
with {BOOKINGS}
select row_number() over (order by k % 3, k) - 1 as id, ['first', 'twice', 'broken'][k % 3 + 1] as load, reason,
       case when k % 29 = 0 then repeat('H', 50) else hotel end as hotel, cast(k % 400 as int) as lead_time,
       cast(case when k % 17 = 0 then null when k % 19 = 0 then price + 0.01 else price end as double) as adr,
       case when k % 7 <> 0 then cast(g as varchar) end as agent
from reasoned
""",
    "ingest_rejects": f"""
with {BOOKINGS} select reason, count(*) as hata_sayisi from reasoned where reason is not null group by 1
""",
    "first_rejects": f"with {BOOKINGS} select k as id, reason from reasoned where reason is not null order by k limit 5",
    "null_sentinels": f"with {BOOKINGS} select id, children, agent, company, country, meal from good",
    "normalise_guests": f"""
with {BOOKINGS}
select id as musteri_id, country as ulke, customer_type as musteri_tipi, is_repeated_guest as tekrar_misafir,
       md5(cast(id as varchar)) || '$' || sha256('test-pepper' || md5(cast(id as varchar)) ||
       '4' || lpad(cast((id * 7919000003) % 900000000000000 + 100000000000000 as varchar), 15, '0')) as kredi_karti
from good
""",
    "normalise_reservations": f"""
with {BOOKINGS}
select id as rezervasyon_id, id as musteri_id,
       * exclude (id, country, customer_type, is_repeated_guest, previous_cancellations, previous_bookings_not_canceled)
from good
""",
    "check_not_null": f"""
with {UNCHECKED}
select * from (
    select 'open_price' as column_name, count(*) - count(open_price) as violations from u
    union all select 'close_price', count(*) - count(close_price) from u
    union all select 'symbol', count(*) - count(symbol) from u
) where violations > 0
""",
    "check_unique": f"with {UNCHECKED} select id, count(*) as copies from u group by id having count(*) > 1",
    "check_unique_composite": f"""
with {UNCHECKED} select id, {day("trade_date")} as trade_date, count(*) as copies from u group by id, u.trade_date having count(*) > 1
""",
    "check_fk": f"""
with {UNCHECKED}
select part_id + 1000000000000 as part_id, count(*) as orphans from u where id % 37 = 0 group by 1
""",
    "check_length": f"""
with {UNCHECKED}
select 'symbol' as column_name, count_if(length(rtrim(symbol)) > 10) as violations, cast(max(length(rtrim(symbol))) as int) as longest from u
""",
    "check_numeric": f"""
with {UNCHECKED}
select case when try_cast(amount as decimal(38,2)) is null then 'not a number' else 'out of range' end as reason,
       count(*) as violations
from u where try_cast(amount as decimal(10,2)) is null group by 1
""",
    "check_partition_range": f"""
with {UNCHECKED}
select cast(year(trade_date) as int) as trade_year, count(*) as violations from u
where not (trade_date >= date '1996-01-01' and trade_date < date '2001-01-01') group by 1
""",
    "row_faults": f"""
with {UNCHECKED}, f as (
    select concat_ws(',', case when open_price is null then 'open_price is null' end,
                     case when length(symbol) > 10 then 'symbol too long' end,
                     case when year(trade_date) not between 1996 and 2000 then 'no partition' end) as faults
    from u
)
select faults, count(*) as satir_sayisi from f group by 1
""",
}
