from oracle.texts import day, mean, ratio, stamp

RES = """
res as (
    select o_orderkey as rezervasyon_id, o_custkey as musteri_id,
           case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'City Hotel'
                when o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then 'Resort Hotel' end as hotel,
           cast(o_orderstatus = 'F' as int) as is_canceled,
           cast(o_totalprice as decimal(10,2)) as adr,
           o_orderstatus as reservation_status,
           cast(o_orderdate as date) as reservation_status_date
    from orders
)
"""
GUESTS = """
gst as (
    select c_custkey as musteri_id, n_name as ulke, c_mktsegment as musteri_tipi,
           cast(c_acctbal > 0 as int) as tekrar_misafir
    from customer join nation on c_nationkey = n_nationkey
)
"""
CHANGES = """
chg as (
    select event_id as seq, ts as islem_zamani,
           case event_type when 'purchase' then 'admin' when 'click' then 'city_reception'
                when 'view' then 'resort_reception' when 'signup' then 'manager' else 'visitor' end as role,
           user_id as rezervasyon_id,
           cast(case when event_id % 97 <> 0 then value end as decimal(10,2)) as new_adr
    from events
)
"""


def _guard(role: str) -> str:
    return (
        f"coalesce(({role} = 'city_reception' and hotel = 'City Hotel') "
        f"or ({role} = 'resort_reception' and hotel = 'Resort Hotel') or {role} in ('admin', 'manager'), false)"
    )


def _rows_for(role: str) -> str:
    return f"""
with {RES}
select rezervasyon_id, musteri_id, hotel, is_canceled, cast(adr as double) as adr, reservation_status,
       {day("reservation_status_date")} as reservation_status_date
from res where {_guard(f"'{role}'")}
"""


def _decisions(grant: bool) -> str:
    may = "role in ('admin', 'manager')" if grant else "true"
    return f"""
{RES}, {CHANGES}, flagged as (
    select c.*, r.hotel, r.adr, {may} as may, {_guard("role")} as seen
    from chg c join res r on r.rezervasyon_id = c.rezervasyon_id
), numbered as (
    select *, may and seen and role not in ('city_reception', 'resort_reception') as applied from flagged
), met as (
    select a.*, max(case when applied then seq end) over w as last_seq
    from numbered a
    window w as (partition by rezervasyon_id order by seq rows between unbounded preceding and 1 preceding)
), decided as (
    select m.seq, m.islem_zamani, m.role, m.rezervasyon_id, m.hotel, m.new_adr as yeni_deger,
           case when m.last_seq is null then m.adr else p.new_adr end as eski_deger, m.may, m.seen
    from met m left join chg p on p.seq = m.last_seq
), dec as (
    select *, case when not may then 'NO_GRANT' when not seen then 'INVISIBLE'
                   when eski_deger is not distinct from yeni_deger then 'UNCHANGED'
                   when role in ('city_reception', 'resort_reception') then 'ENGELLENDI'
                   when role = 'admin' then 'IZIN VERILDI' else 'APPLIED' end as karar,
              {ratio("cast((yeni_deger - eski_deger) * 100 as bigint) * 100", "cast(eski_deger * 100 as bigint)", 2)} as degisim,
              {_percent_units()} as degisim_q
    from decided
)
"""


def _percent_units() -> str:
    """The percentage in hundredths, for its text form."""
    delta, old = "cast((yeni_deger - eski_deger) * 100 as hugeint)", "cast(eski_deger * 100 as hugeint)"
    return (
        f"case when eski_deger = 0 then null else cast(sign({delta}) * sign({old}) * "
        f"((abs({delta}) * 20000 + abs({old})) // (2 * abs({old}))) as bigint) end"
    )


_TEXT = """
'Kullanici: ' || role || ' | Saat: ' || strftime(islem_zamani, '%Y-%m-%d %H:%M:%S') || ' | Islem: ' ||
case when karar = 'ENGELLENDI' then 'Yetkisiz Fiyat Degisiklik Denemesi' else 'Admin Fiyat Guncelleme' end ||
' | Otel: ' || coalesce(hotel, '') || ' | Degisim: %' || coalesce(cast(cast(degisim_q / 100.0 as decimal(18,2)) as varchar), '')
"""


def _audit(grant: bool) -> str:
    return f"""
with {_decisions(grant)}
select seq as log_id, role as kullanici_adi, {stamp("islem_zamani")} as islem_zamani, 'rezervasyonlar' as tablo_adi,
       karar as islem_turu, {_TEXT} as aciklama, cast(eski_deger as double) as eski_deger,
       cast(yeni_deger as double) as yeni_deger, rezervasyon_id
from dec where karar in ('ENGELLENDI', 'IZIN VERILDI')
"""


def _every_decision(grant: bool) -> str:
    return f"""
with {_decisions(grant)}
select seq, {stamp("islem_zamani")} as islem_zamani, role, rezervasyon_id, hotel, cast(eski_deger as double) as eski_deger,
       cast(yeni_deger as double) as yeni_deger, karar, degisim
from dec
"""


_LOOKUP = f"""
with {RES}, {GUESTS}
select r.rezervasyon_id, hotel, ulke, cast(adr as double) as adr, reservation_status
from res r join gst g on r.musteri_id = g.musteri_id where ulke = '$C' order by rezervasyon_id limit 20
"""

_RIGHTS = """
rights as (
    select 'user_' || user_id as grantee,
           case when value < 20 then 'stock_prices' when value < 60 then 'query_audit_log' else 'rezervasyonlar' end as table_name,
           case event_type when 'view' then 'SELECT' when 'signup' then 'INSERT' when 'click' then 'UPDATE'
                when 'purchase' then 'DELETE' else 'REFERENCES' end as privilege_type,
           value
    from events
)
"""

def _hashed(cost: int) -> str:
    """The hash of a card number, taken again ``cost`` times."""
    out = "sha256('test-pepper' || salt || pan)"
    for _ in range(cost):
        out = f"sha256({out} || 'test-pepper' || salt)"
    return out


SQL = {
    "rows_for_city_reception": _rows_for("city_reception"),
    "rows_for_resort_reception": _rows_for("resort_reception"),
    "rows_for_admin": _rows_for("admin"),
    "rows_for_unknown_role": _rows_for("visitor"),
    "guests_for_city_reception": f"""
with {RES}, {GUESTS}
select * from gst where musteri_id in (select musteri_id from res where hotel = 'City Hotel')
""",
    "isolation_report": f"""
with {RES}, roles as (select unnest(['admin', 'city_reception', 'resort_reception', 'visitor']) as rol)
select rol, hotel, count(*) as gordugun_kayit_sayisi from res, roles where {_guard("rol")} group by all
""",
    "session_roles": f"""
with {RES}, steps as (select unnest([1, 2, 3]) as adim, unnest(['city_reception', 'resort_reception', 'manager']) as rol)
select cast(adim as int) as adim, rol, hotel, count(*) as gordugun_kayit_sayisi, count(distinct musteri_id) as misafir
from res, steps
where rol = 'manager' or (rol = 'city_reception' and hotel = 'City Hotel') or (rol = 'resort_reception' and hotel = 'Resort Hotel')
group by all
""",
    "policy_list": f"""
with {RES}
select distinct replace(lower(hotel), ' ', '_') || '_policy' as politika_adi,
       replace(lower(hotel), ' ', '_') || '_reception' as roller, 'ALL' as komut,
       'hotel = ''' || hotel || '''' as kosul
from res where hotel is not null
union all values
    ('city_hotel_policy', 'city_reception', 'ALL', 'hotel = ''City Hotel'''),
    ('resort_hotel_policy', 'resort_reception', 'ALL', 'hotel = ''Resort Hotel'''),
    ('admin_full_access', 'admin', 'ALL', 'true'),
    ('manager_full_access', 'manager', 'ALL', 'true')
""",
    "grant_matrix": f"""
with {_RIGHTS}
select grantee as rol, table_name as tablo, string_agg(distinct privilege_type, ', ' order by privilege_type) as yetkiler,
       any_value(c_mktsegment) as grup
from rights join customer on grantee = 'user_' || c_custkey
where table_name in ('stock_prices', 'query_audit_log') and grantee not in ('user_1', 'user_2')
group by 1, 2
""",
    "grant_check": f"""
with {_RIGHTS}
select distinct grantee, table_name, 'TRUNCATE' as privilege_type from rights
where privilege_type = 'SELECT' and grantee similar to '.*[07]'
""",
    "price_audit": _audit(False),
    "price_audit_granted": _audit(True),
    "price_decisions": _every_decision(False),
    "price_decisions_granted": _every_decision(True),
    "price_after": f"""
with {RES}, {CHANGES}, last as (
    select c.rezervasyon_id, max(c.seq) as seq from chg c join res r on r.rezervasyon_id = c.rezervasyon_id
    where role in ('admin', 'manager') group by 1
)
select r.rezervasyon_id, hotel, cast(case when l.seq is null then r.adr else c.new_adr end as double) as adr
from res r left join last l on l.rezervasyon_id = r.rezervasyon_id left join chg c on c.seq = l.seq
""",
    "audit_report": f"""
with {_decisions(False)}
select seq as log_id, role as kullanici_adi, strftime(islem_zamani, '%d.%m.%Y %H:%M:%S') as zaman, karar as islem_turu,
       cast(eski_deger as double) as "Eski ADR", cast(yeni_deger as double) as "Denenen ADR", {_TEXT} as aciklama
from dec where karar in ('ENGELLENDI', 'IZIN VERILDI')
""",
    "tenant_overview": f"""
with {RES}
select hotel, count(*) as toplam_rezervasyon, {mean("adr", 2, 2)} as ortalama_fiyat,
       cast(sum(case when is_canceled = 1 then 1 else 0 end) as bigint) as iptal_sayisi
from res group by hotel
""",
    "tenant_counts": f"with {RES} select hotel, count(*) as kayit_sayisi from res group by hotel",
    "tenant_counts_for_city_reception": f"""
with {RES} select hotel, count(*) as kayit_sayisi from res where hotel = 'City Hotel' group by hotel
""",
    "lookup_by_country": _LOOKUP.replace("$C", "NATION_7"),
    "lookup_attack": _LOOKUP.replace("$C", "'' OR ''1''=''1'' --"),
    "origin_overview": f"""
with {RES}, {GUESTS}
select r_name as bolge, ulke, count(*) as toplam_rezervasyon, cast(sum(is_canceled) as bigint) as iptal_sayisi
from res join gst on res.musteri_id = gst.musteri_id join nation on ulke = n_name join region on n_regionkey = r_regionkey
group by 1, 2
""",
    "card_tokens": """
select c_custkey as musteri_id, salt || '$' || sha256('test-pepper' || salt || pan) as kredi_karti
from (select c_custkey, md5(cast(c_custkey as varchar)) as salt,
             '4' || lpad(cast((c_custkey * 7919000003) % 900000000000000 + 100000000000000 as varchar), 15, '0') as pan
      from customer)
""",
    "raised_tokens": f"""
with cards as (
    select c_custkey as musteri_id, md5(cast(c_custkey as varchar)) as salt,
           '4' || lpad(cast((c_custkey * 7919000003) % 900000000000000 + 100000000000000 as varchar), 15, '0') as pan
    from customer join nation on c_nationkey = n_nationkey
), old as (
    select *, case when musteri_id % 3 = 0 then salt || '$' || {_hashed(0)} else salt || '$2$' || {_hashed(2)} end as eski from cards
)
select musteri_id, eski, salt || '$4$' || {_hashed(4)} as yeni, case when musteri_id % 3 = 0 then 0 else 2 end as eski_bedel, true as uyuyor
from old
""",
    "masked_cards": f"""
with {GUESTS}
select musteri_id, ulke, musteri_tipi,
       left(salt || '$' || sha256('test-pepper' || salt || pan), 29) || '...' as sifreli_kredi_karti
from (select *, md5(cast(musteri_id as varchar)) as salt,
             '4' || lpad(cast((musteri_id * 7919000003) % 900000000000000 + 100000000000000 as varchar), 15, '0') as pan
      from gst)
order by musteri_id limit 10
""",
}
# a stream gives what one batch gives
SQL |= {"stream_price_audit": SQL["price_audit"], "stream_price_after": SQL["price_after"]}
