"""The registered queries as plain SQL for DuckDB, on the same source tables.

Written from the rules, independently of the Spark operators: distinct counts, joins,
anti joins, correlated look-ups and aggregate percentiles stand where the operators
use masks, windows and bands.
"""

from __future__ import annotations

import datetime as dt

from retalia.operators.migration import SUCURSALES
from retalia.operators.quality import REGLAS
from retalia.operators.wholesale import NIVELES
from retalia.plans.queries import (
    AS_OF,
    AS_OF_PREVIO,
    CLIENTE_PRUEBA,
    CONOCIDO_HASTA,
    CORREGIDO,
    CORRIDAS,
    FOTOS,
    MESES_CONSULTA,
    MOMENTO,
    MOMENTO_PREVIO,
    UMBRAL_VENTAS,
    params,
)
from retalia.sources.seeds import PRODUCTOS_EXCLUIDOS
from retalia.sources.seeds import SUCURSALES as SEED_SUCURSALES


def _lista(textos) -> str:
    return ", ".join(f"'{t}'" for t in textos)


def _money(expr: str) -> str:
    return f"cast(sum(cast({expr} as decimal(18,4))) as double)"


# -- source tables -----------------------------------------------------------------


def _document(key: str) -> str:
    return f"cast(100000 + {key} - {key} % 2 as varchar)"


def _raw_id(key: str) -> str:
    d = _document(key)
    return f"""case when {key} % 97 = 0 then 'SIN NOMBRE'
      when {key} % 8 = 0 then {d} || '-' || cast({key} % 10 as varchar)
      when {key} % 8 = 1 then '|' || {d}
      when {key} % 8 = 2 then {d} || ',' || cast({key} % 10 as varchar)
      when {key} % 8 = 3 then 'CI ' || {d}
      when {key} % 8 = 4 then {d} || '*7'
      else {d} end"""


def _product_id(key: str) -> str:
    return f"case when {key} % 50 = 0 then cast({key} as varchar) || '-G' else cast({key} as varchar) end"


_SIGN = "case when l_returnflag = 'R' and l_linenumber = 7 then -1.0::double else 1.0::double end"


def _stripped(x: str) -> str:
    return f"regexp_replace(upper({x}), '[A-Z \\t\\n\\r]', '', 'g')"


def _trimmed(x: str) -> str:
    return f"regexp_extract({x}, '(?s)[0-9](.*[0-9])?')"


def _derived(c: str) -> str:
    return f"""nullif(case
      when strpos({c}, '-') > 0 then left({c}, strpos({c}, '-') - 1)
      when strpos({c}, '*') > 0 then left({c}, strpos({c}, '*') - 1)
      when regexp_matches(right({c}, 2), '^[^0-9][0-9]$') then left({c}, length({c}) - 2)
      else {c} end, '')"""


_NAME = (
    "trim(regexp_replace(translate(upper({x}), 'ÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÄËÏÖÜÃÕÑÇ|', "
    "'AEIOUAEIOUAEIOUAEIOUAONC'), '\\s+', ' ', 'g'))"
)


def _like_ci_ai(col: str, text: str) -> str:
    return f"lower(strip_accents(coalesce({col}, ''))) like '%{text}%'"


_BASE: dict[str, str] = {
    "branches": "select * from (values "
    + ", ".join(f"('{p}', '{c}')" for p, c, _ in SEED_SUCURSALES)
    + ") t(pdv_id, sucursal_codigo)",
    "excluded": f"select unnest([{_lista(PRODUCTOS_EXCLUIDOS)}]) as producto_id",
    "sales": f"""
      select {_raw_id('o_custkey')} as cliente_id,
        {_product_id('l_partkey')} as producto_id,
        case when l_suppkey % 10 < 1 then '4' when o_custkey % 3 = 0 then '3'
             when (o_custkey + o_orderkey) % 5 < 3 then '5' else '6' end as pdv_id,
        cast(o_orderdate as date) as fecha_venta,
        {_SIGN} * l_extendedprice * (1 - l_discount) as venta_gs,
        {_SIGN} * l_quantity as unidades,
        case when l_orderkey % 101 = 0 then null
             else cast(10000000 + l_orderkey % 7 as varchar) end as timbrado,
        cast(l_orderkey as varchar) as factura_nro
      from lineitem join orders on l_orderkey = o_orderkey""",
    "customers": f"""
      select case when c_custkey % 97 <> 0 and c_custkey % 11 = 0 then cast(900000 + c_custkey as varchar)
                  else {_raw_id('c_custkey')} end as cliente_id,
        case when c_custkey % 5 = 0 then null else {_document('c_custkey')} end as ci_ruc,
        c_name as nombre, '09' || cast(c_custkey as varchar) as celular,
        'c' || cast(c_custkey as varchar) || '@x.py' as mail
      from customer""",
    "products": f"""
      select {_product_id('p_partkey')} as producto_id,
        cast(case when p_partkey % 20 = 1 then 1 else 3 end as bigint) as id_empresa,
        case when p_partkey % 37 = 0 then 'EGRESOS' when p_partkey % 41 = 0 then 'Servicios'
             else p_type end as categoria_1,
        case when p_partkey % 43 = 0 then 'BÓLSA reutilizable' when p_partkey % 11 = 0 then null
             else p_name end as categoria_2,
        cast(null as varchar) as categoria_3, cast(null as varchar) as categoria_4,
        cast(null as varchar) as categoria_5, p_name as nombre, p_brand as marca,
        cast(null as varchar) as unidad_medida
      from part""",
    "normalized": f"""
      select cliente_id, cliente_id_clean, {_derived('cliente_id_clean')} as cliente_id_limpio,
        ci_ruc_clean, nombre_limpio, celular, mail
      from (select *, {_trimmed(_stripped('cliente_id'))} as cliente_id_clean,
              {_stripped("coalesce(ci_ruc, '')")} as ci_ruc_clean,
              {_NAME.format(x='nombre')} as nombre_limpio
            from customers)""",
    "orphans": """
      select distinct s.cliente_id from sales s
      where not exists (select 1 from normalized n where n.cliente_id = s.cliente_id)""",
    "mapping": f"""
      select cliente_id, min(cliente_id_limpio) as cliente_id_limpio
      from (select cliente_id, cliente_id_limpio from normalized
            union all
            select cliente_id, {_derived(_trimmed(_stripped('cliente_id')))} from orphans)
      group by cliente_id having min(cliente_id_limpio) is not null""",
    "clean_customers": """
      select cliente_id_limpio, max(nombre_limpio) as nombre, min(ci_ruc_clean) as ci_ruc,
        max(celular) as celular, max(mail) as mail
      from normalized where cliente_id_limpio is not null group by cliente_id_limpio""",
    "eligible": f"""
      select s.cliente_id, m.cliente_id_limpio, s.producto_id, s.pdv_id, s.fecha_venta, s.venta_gs, s.unidades,
        coalesce(s.timbrado, '') || '_' || coalesce(s.factura_nro, '') as ticket_id
      from sales s
      join mapping m on m.cliente_id = s.cliente_id
      join products p on p.producto_id = s.producto_id
      where m.cliente_id_limpio <> '{CLIENTE_PRUEBA}' and p.id_empresa = 3
        and not {_like_ci_ai('p.categoria_2', 'bolsa')}
        and not {_like_ci_ai('p.categoria_1', 'egre')}
        and not {_like_ci_ai('p.categoria_1', 'servi')}
        and s.producto_id not in (select producto_id from excluded)""",
}


# -- datasets of one run date ------------------------------------------------------

_SIGNATURES = {
    "100": "Cliente SL",
    "010": "Cliente R1",
    "001": "Cliente R2",
    "110": "Cliente Dual SL y R1",
    "101": "Cliente Dual SL y R2",
    "011": "Cliente Dual R1 y R2",
    "111": "Cliente SL, R1 y R2",
}
_MOVES = {
    ("SL", "R1"): "Migro de SL a R1",
    ("SL", "R2"): "Migro de SL a R2",
    ("SL", "R1R2"): "Migro de SL a R1 y R2",
    ("R1", "SL"): "Migro de R1 a SL",
    ("R1", "R2"): "Migro de R1 a R2",
    ("R1", "SLR2"): "Migro de R1 a SL y R2",
    ("R2", "SL"): "Migro de R2 a SL",
    ("R2", "R1"): "Migro de R2 a R1",
    ("R2", "SLR1"): "Migro de R2 a SL y R1",
}


def _ctes(as_of: dt.date, tag: str = "") -> dict[str, str]:
    p = params(as_of)
    cut = p.corte
    t = tag
    months = "(p1 // 100 * 12 + p1 % 100 - p0 // 100 * 12 - p0 % 100)"

    def between(a: str, b: str) -> str:
        return months.replace("p1", a).replace("p0", b)

    def scale(short: str) -> str:
        return f"""case when max(l_{short}) over (partition by ambito) = min(l_{short}) over (partition by ambito)
          then 100.0::double else round((l_{short} - min(l_{short}) over (partition by ambito)) * 100.0::double
            / (max(l_{short}) over (partition by ambito) - min(l_{short}) over (partition by ambito)), 8) end
          as norm_{short}"""

    shorts = {
        "ventas": "ventas",
        "tickets": "tickets_por_producto",
        "unidades_dia": "unidades_por_dia",
        "unidades_ticket": "unidades_por_ticket",
    }
    measures = (
        "tickets_por_producto, unidades_totales, ventas, dias_con_ventas, unidades_por_ticket, unidades_por_dia"
    )
    norms = ", ".join(f"norm_{s}" for s in shorts)
    score = " + ".join(
        f"norm_{s} * {w}::double" for s, w in zip(shorts, ("0.4", "0.3", "0.2", "0.1"), strict=True)
    )
    running = ", ".join(
        f"""cast(sum(cast({s} as decimal(18,4))) over (partition by cliente_id_limpio order by anio, mes
            rows unbounded preceding) as double) as {s.lower()}_acumulado"""
        for s in SUCURSALES
    )
    previous = ", ".join(
        f"lag({s.lower()}_acumulado) over (partition by cliente_id_limpio order by anio, mes) as p{s}"
        for s in SUCURSALES
    )

    def signature(op: str) -> str:
        return " || ".join(f"case when {s.lower()}_acumulado {op} 0 then '1' else '0' end" for s in SUCURSALES)

    def left_from(s: str) -> str:
        others = " and ".join(f"p{o} = 0" for o in SUCURSALES if o != s)
        return f"{s.lower()}_acumulado = p{s} and {others}"

    def reached(s: str) -> str:
        others = [o for o in SUCURSALES if o != s]
        valid = " and ".join(f"{o.lower()}_acumulado >= 0" for o in others)
        names = " || ".join(f"case when {o.lower()}_acumulado > 0 then '{o}' else '' end" for o in others)
        return f"case when {valid} then {names} else '' end"

    signatures = ", ".join(f"('{k}', '{v}')" for k, v in _SIGNATURES.items())
    moves = ", ".join(f"('{a}', '{b}', '{v}')" for (a, b), v in _MOVES.items())

    return {
        f"v12{t}": f"""select * from eligible
          where fecha_venta >= date '{p.inicio_ventana(12)}' and fecha_venta < date '{cut}'""",
        f"v36{t}": f"""
          select cliente_id_limpio, producto_id, pdv_id, cast(year(fecha_venta) as int) as anio,
            cast(month(fecha_venta) as int) as mes, {_money('venta_gs')} as total_ventas
          from eligible where fecha_venta >= date '{p.inicio_ventana(36)}' and fecha_venta < date '{cut}'
          group by all""",
        f"pivoted{t}": f"""
          select a.*, c.nombre from (
            select cliente_id_limpio, anio, mes, {", ".join(
                f"cast(sum(case when sucursal_codigo = '{s}' then cast(total_ventas as decimal(18,4)) else 0 end)"
                f" as double) as {s}" for s in SUCURSALES)}
            from v36{t} join branches using (pdv_id) group by cliente_id_limpio, anio, mes) a
          left join clean_customers c using (cliente_id_limpio)""",
        # v1: states
        f"balances{t}": f"""
          select *, {previous} from (
            select cliente_id_limpio, anio, mes, SL, R1, R2, {running} from pivoted{t}
            where SL <> 0 or R1 <> 0 or R2 <> 0)""",
        f"situations{t}": f"""
          select *, case when pSL is null then 'first'
              {" ".join(f"when {left_from(s)} then '{s}'" for s in SUCURSALES)} else 'stable' end as origin,
            case when pSL is null then {signature('>')} else {signature('<>')} end as sig,
            case {" ".join(f"when {left_from(s)} then {reached(s)}" for s in SUCURSALES)} else '' end as dest
          from balances{t}""",
        f"states{t}": f"""
          select cliente_id_limpio, anio, mes, SL, R1, R2, sl_acumulado, r1_acumulado, r2_acumulado,
            case when s.origin in ('first', 'stable') then g.label
                 else coalesce(m.label, 'Cliente ' || s.origin) end as tipo_cliente
          from situations{t} s
          left join (values {signatures}) g(sig, label) on g.sig = s.sig
          left join (values {moves}) m(origin, dest, label) on m.origin = s.origin and m.dest = s.dest""",
        # v3: events
        f"bought{t}": f"""select *, anio * 100 + mes as periodo from pivoted{t}
          where SL > 0 or R1 > 0 or R2 > 0""",
        f"in_window{t}": f"""select * from bought{t}
          where {between(f"(select max(periodo) from bought{t})", "periodo")} <= 23""",
        f"base{t}": f"""
          select b.cliente_id_limpio, nombre, anio, mes, cast(periodo as int) as periodo, SL, R1, R2,
            cast(primero as int) as primer_periodo_ventana,
            case when periodo = primero then 'Nuevo' else 'Recurrente' end as tipo_global
          from in_window{t} b join (
            select cliente_id_limpio, min(periodo) as primero from in_window{t}
            group by cliente_id_limpio having count(*) > 1) f on f.cliente_id_limpio = b.cliente_id_limpio""",
        f"evolution{t}": " union all ".join(
            f"""select cliente_id_limpio, nombre, anio, mes, periodo, '{s}' as sucursal, {s} as monto,
                tipo_global, primer_periodo_ventana from base{t} where {s} > 0"""
            for s in SUCURSALES
        ),
        f"arrivals{t}": f"""
          select cliente_id_limpio, sucursal, primero,
            first_value(sucursal) over w as origen, first_value(primero) over w as primero_origen,
            count(*) over (partition by cliente_id_limpio) as sucursales
          from (select cliente_id_limpio, sucursal, min(periodo) as primero
                from evolution{t} group by all)
          window w as (partition by cliente_id_limpio order by primero, sucursal)""",
        f"events{t}": f"""
          select a.cliente_id_limpio,
            case when sucursales = 1 then 'Nuevo - Unico'
              else case when primero = primero_origen then 'Nuevo' else 'Recurrente' end || ' - ' ||
                case when {between('primero', '''(select max(e.periodo) from evolution{t} e
                    where e.cliente_id_limpio = a.cliente_id_limpio and e.sucursal = a.origen
                      and e.periodo < a.primero)'''.replace('{t}', t))} > 3 then 'Migracion' else 'Dual' end
              end as tipo_cliente,
            origen as local_origen, a.sucursal as local_destino, primero as periodo_evento,
            cast(primero // 100 as int) as anio, cast(primero % 100 as int) as mes, v.monto as monto_total
          from arrivals{t} a
          left join evolution{t} v on v.cliente_id_limpio = a.cliente_id_limpio
            and v.periodo = a.primero and v.sucursal = a.sucursal
          where sucursales = 1 or a.sucursal <> origen""",
        # products
        f"scoped{t}": f"""
          select 'GLOBAL' as ambito, * from v12{t} union all select pdv_id as ambito, * from v12{t}""",
        f"measures{t}": f"""
          select ambito, producto_id, tickets_por_producto, unidades_totales, ventas, dias_con_ventas,
            unidades_totales / tickets_por_producto as unidades_por_ticket,
            unidades_totales / dias_con_ventas as unidades_por_dia
          from (select ambito, producto_id, count(distinct ticket_id) as tickets_por_producto,
              {_money('unidades')} as unidades_totales, {_money('venta_gs')} as ventas,
              count(distinct fecha_venta) as dias_con_ventas from scoped{t} group by ambito, producto_id)
          where ventas > {UMBRAL_VENTAS}""",
        f"logs{t}": f"""select *, {", ".join(
            f"ln(1 + {m} - min({m}) over (partition by ambito)) as l_{s}" for s, m in shorts.items())}
          from measures{t}""",
        f"kpis{t}": f"select ambito, producto_id, {measures}, {', '.join(map(scale, shorts))} from logs{t}",
        f"buckets{t}": f"""
          select ambito, producto_id, count(*) filter (u between 1 and 2) as tickets_1_2,
            count(*) filter (u between 3 and 5) as tickets_3_5, count(*) filter (u >= 6) as tickets_6_mas
          from (select ambito, producto_id, ticket_id, {_money('unidades')} as u from scoped{t} group by all)
          group by ambito, producto_id""",
        f"ranking{t}": f"""
          select r.ambito, r.producto_id, posicion, puntaje_final, {norms}, ventas, tickets_por_producto,
            unidades_totales, dias_con_ventas, unidades_por_ticket, unidades_por_dia,
            coalesce(tickets_1_2, 0) as tickets_1_2, coalesce(tickets_3_5, 0) as tickets_3_5,
            coalesce(tickets_6_mas, 0) as tickets_6_mas
          from (select *, cast(row_number() over (partition by ambito
                  order by puntaje_final desc, ventas desc, producto_id) as int) as posicion
                from (select *, round({score}, 10) as puntaje_final from kpis{t})) r
          left join buckets{t} b on b.ambito = r.ambito and b.producto_id = r.producto_id
          where posicion <= 300""",
        # wholesale
        f"cut{t}": f"""
          select q1, q3, q3 + 1.5::double * (q3 - q1) as umbral_ticket_grande from (
            select quantile_cont(u, 0.25) as q1, quantile_cont(u, 0.75) as q3
            from (select ticket_id, {_money('unidades')} as u from v12{t} group by ticket_id) where u > 0)""",
        f"wscoped{t}": f"""
          select 'GLOBAL' as ambito, cliente_id_limpio, ticket_id, unidades, venta_gs, fecha_venta from v12{t}
          union all
          select sucursal_codigo, cliente_id_limpio, ticket_id, unidades, venta_gs, fecha_venta
          from v12{t} join branches using (pdv_id)""",
        f"wtickets{t}": f"""
          select ambito, cliente_id_limpio, count(*) as tickets, sum(u) as units,
            count(*) filter (u > (select umbral_ticket_grande from cut{t})) as big
          from (select ambito, cliente_id_limpio, ticket_id, {_money('unidades')} as u
                from wscoped{t} group by all) where u > 0 group by all""",
        f"wmetrics{t}": f"""
          select t.ambito, t.cliente_id_limpio, tickets as tickets_unicos, dias_con_compra,
            units / tickets as upt, big::double / tickets as pct_tickets_grandes, ventas_totales
          from wtickets{t} t join (
            select ambito, cliente_id_limpio, count(distinct fecha_venta) as dias_con_compra,
              {_money('venta_gs')} as ventas_totales from wscoped{t} group by all) o
          on o.ambito = t.ambito and o.cliente_id_limpio = t.cliente_id_limpio""",
        f"wcuts{t}": f"""
          select ambito, quantile_cont(upt, 0.75) as umbral_upt,
            greatest(0.4::double, quantile_cont(pct_tickets_grandes, 0.75)) as umbral_pct,
            quantile_cont(ventas_totales, 0.75) as umbral_ventas from wmetrics{t} group by ambito""",
        f"wholesale{t}": f"""
          select *, list_value({_lista(NIVELES)})[puntaje + 1] as nivel_mayorista from (
            select *, c1_upt_alto + c2_pct_grandes_alto + c3_ventas_alto as puntaje from (
              select m.*, cast(upt >= umbral_upt as int) as c1_upt_alto,
                cast(pct_tickets_grandes >= umbral_pct as int) as c2_pct_grandes_alto,
                cast(ventas_totales >= umbral_ventas as int) as c3_ventas_alto,
                umbral_upt, umbral_pct, umbral_ventas
              from wmetrics{t} m join wcuts{t} using (ambito)))""",
    }


_HOY = {**_BASE, **_ctes(AS_OF)}
_AMBAS = {**_HOY, **_ctes(AS_OF_PREVIO, "_prev")}


def _con(ctes: dict[str, str], final: str) -> str:
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in ctes.items()) + "\n" + final


def _hoy(final: str, extra: dict[str, str] | None = None) -> str:
    return _con({**_HOY, **(extra or {})}, final)


def _scd2(key: str, cols: list[str], check: list[str], source: str, close_missing: bool) -> str:
    """Two runs: the first opens a version of each row, the second compares."""
    old_ts, new_ts = f"timestamp '{MOMENTO_PREVIO}'", f"timestamp '{MOMENTO}'"
    changed = " or ".join(f"o.{c} is distinct from n.{c}" for c in check)
    c_old, c_new = (", ".join(f"{a}.{c}" for c in cols) for a in "on")
    ended = f"n.k is not null and ({changed})" + (" or n.k is null" if close_missing else "")
    ctes = {
        **_AMBAS,
        "o": f"select {key} as k, {', '.join(cols)} from {source}_prev",
        "n": f"select {key} as k, {', '.join(cols)} from {source}",
    }
    name = "cliente_mes_key" if "anio" in cols else "ambito_cliente_key"
    return _con(
        ctes,
        f"""select o.k as {name}, {c_old}, md5(o.k || '|' || cast({old_ts} as varchar)) as dbt_scd_id,
              {old_ts} as dbt_updated_at, {old_ts} as dbt_valid_from,
              case when {ended} then {new_ts} end as dbt_valid_to
            from o left join n on n.k = o.k
            union all
            select n.k, {c_new}, md5(n.k || '|' || cast({new_ts} as varchar)), {new_ts}, {new_ts}, null
            from n left join o on o.k = n.k where o.k is null or {changed}""",
    )


_RAW_IDS = {"raw_ids": "select cliente_id from customers union select cliente_id from sales"}
_OTHER = r"regexp_matches(cliente_id, '[^A-Za-z0-9 \t\n\r*-]')"
_COMPARED = {
    "previous": r"""
      select cliente_id, min(coalesce(nullif(split_part(regexp_replace(upper(cliente_id), '[A-Z ]', '', 'g'),
        '-', 1), ''), cliente_id)) as cliente_id_limpio_legacy from customers group by cliente_id""",
    "compared": """
      select coalesce(p.cliente_id, m.cliente_id) as cliente_id, p.cliente_id_limpio_legacy,
        m.cliente_id_limpio as cliente_id_limpio_nuevo
      from previous p full join mapping m on m.cliente_id = p.cliente_id""",
}
_MERGED = {
    "merged": """select cliente_id_limpio, count(distinct cliente_id) as cantidad_ids_origen
      from mapping group by cliente_id_limpio""",
    "candidates": """
      select e.cliente_id_limpio, local_origen, local_destino, anio, mes from events e
      join merged m on m.cliente_id_limpio = e.cliente_id_limpio
      where tipo_cliente = 'Nuevo - Dual' and cantidad_ids_origen > 1""",
    "seen": """
      select distinct s.cliente_id as cliente_id_crudo, s.cliente_id_limpio, b.sucursal_codigo as sucursal
      from eligible s join branches b on b.pdv_id = s.pdv_id
      join candidates c on c.cliente_id_limpio = s.cliente_id_limpio
        and c.anio = year(s.fecha_venta) and c.mes = month(s.fecha_venta)
        and b.sucursal_codigo in (c.local_origen, c.local_destino)""",
}

_p = params()
_recent = f"fecha_venta >= date '{_p.inicio_lookback}'"

_SUITE_SOURCES = {
    "stg_ventas": "(select * from sales where cliente_id is not null)",
    "stg_clientes": "(select * from customers where cliente_id is not null)",
    "stg_productos": "products",
    "stg_clientes_mapeo": "mapping",
    "stg_clientes_limpio": "clean_customers",
    "int_clientes_normalizados": "(select * from normalized where cliente_id is not null)",
    "int_clientes_mapeo_limpio": "mapping",
    "int_clientes_limpio": "clean_customers",
    "int_ventas_elegibles": "eligible",
    "int_ventas_12m": "v12",
    "fct_ventas_36m": "v36",
    "fct_ventas_36m_pivotado": "pivoted",
    "dim_cliente_tipo_migracion": "states",
    "int_canibalizacion_migracion_base": "base",
    "fct_canibalizacion_evolutivo_cliente": "evolution",
    "dim_cliente_migracion_eventos": "events",
    "fct_canibalizacion_migracion_resumen": """(select anio, mes, tipo_cliente, count(*) as cantidad_clientes
      from events group by anio, mes, tipo_cliente, local_origen, local_destino)""",
    "int_top300_kpis": "kpis",
    "top300_ranking": "ranking",
    "int_mayoristas_metricas_cliente": "wmetrics",
    "dim_clientes_mayoristas": "wholesale",
}


def _suite() -> list[str]:
    """A statement for every declared check, and for the two singular ones."""

    def one(ds: str, test: str, severity: str, source: str, bad: str) -> str:
        return f"""select '{ds}' as conjunto, '{test}' as prueba, '{severity}' as severidad, count(*) as fallas
          from {source} where {bad}"""

    out = []
    for ds, source in _SUITE_SOURCES.items():
        rules = REGLAS[ds]
        out += [one(ds, f"not_null:{c}", "error", source, f"{c} is null") for c in rules.get("no_nulas", [])]
        out += [
            one(ds, f"accepted_values:{c}", "error", source, f"{c} not in ({_lista(vs)})")
            for c, vs in rules.get("valores", {}).items()
        ]
        out += [
            one(ds, f"unique:{c}", "error", f"(select {c} from {source} where {c} is not null group by 1 having count(*) > 1)", "true")
            for c in rules.get("unicas", [])
        ]
    out.append(one("int_clientes_mapeo_limpio", "ids_por_cliente", "error", "merged", "cantidad_ids_origen > 1"))
    out.append(
        one("ventas", "ventas_desactualizada", "warn", "(select max(fecha_venta) as d from sales)", "d < date '2001-09-30'")
    )
    return out


ORACLE_SQL: dict[str, str] = {
    "stg_ventas": _hoy("select * from sales where cliente_id is not null"),
    "stg_clientes": _hoy("select * from customers where cliente_id is not null"),
    "stg_productos": _hoy("select * from products"),
    "stg_clientes_mapeo": _hoy("select left(cliente_id, 50) as cliente_id, left(cliente_id_limpio, 50) as cliente_id_limpio from mapping"),
    "stg_clientes_limpio": _hoy("select cliente_id_limpio, nombre from clean_customers"),
    "clean_ids": _hoy(
        f"""select cliente_id, {_stripped('cliente_id')} as sin_letras,
          {_trimmed(_stripped('cliente_id'))} as cliente_id_clean,
          {_derived(_trimmed(_stripped('cliente_id')))} as cliente_id_limpio from raw_ids""",
        _RAW_IDS,
    ),
    "fecha_corte": _hoy(
        """select fecha_venta, count(*) as lineas, make_date(year(fecha_venta), month(fecha_venta), 1) as fecha_corte
        from sales group by fecha_venta"""
    ),
    "meses_entre_periodos": _hoy(
        f"""select cast(year(fecha_venta) * 100 + month(fecha_venta) as int) as periodo, count(*) as lineas,
          cast(datediff('month', date_trunc('month', min(fecha_venta)), date '{_p.corte}') as int) as meses
        from sales group by 1"""
    ),
    "normalizar_log": _hoy(
        f"""select producto_id, ventas, case when max(ventas) over () = min(ventas) over () then 100
          else round(ln(1 + ventas - min(ventas) over ()) * 100.0::double
            / ln(1 + max(ventas) over () - min(ventas) over ()), 8) end as norma
        from (select producto_id, {_money('venta_gs')} as ventas from sales group by producto_id)"""
    ),
    "clientes_normalizados": _hoy("select * from normalized"),
    "mapeo_limpio": _hoy("select * from mapping"),
    "clientes_limpio": _hoy("select * from clean_customers"),
    "ventas_elegibles": _hoy("select * from eligible"),
    "ventas_elegibles_mapeo": _hoy("select * from eligible"),
    "ventas_12m": _hoy("select * from v12"),
    "ventas_36m": _hoy("select * from v36"),
    "ventas_pivotado": _hoy("select * from pivoted"),
    "tipo_migracion": _hoy("select * from states"),
    "migracion_base": _hoy("select * from base"),
    "evolutivo": _hoy("select * from evolution"),
    "migracion_eventos": _hoy("select * from events"),
    "migracion_resumen": _hoy(
        f"""select anio, mes, tipo_cliente, local_origen, local_destino, count(*) as cantidad_clientes,
          {_money('monto_total')} as monto_total from events group by all"""
    ),
    "top300_kpis": _hoy("select * from kpis"),
    "top300_ranking": _hoy("select * from ranking"),
    "umbral_ticket_grande": _hoy("select * from cut"),
    "metricas_cliente": _hoy("select * from wmetrics"),
    "mayoristas": _hoy("select * from wholesale"),
    "upsert_mapeo": _hoy(
        "select * from before where cliente_id not in (select cliente_id from now) union all select * from now",
        {
            name: f"""
              select cliente_id, min(cliente_id_limpio) as cliente_id_limpio from (
                select cliente_id, cliente_id_limpio from normalized union all
                select cliente_id, {_derived(_trimmed(_stripped('cliente_id')))} from sales
                where {cond} and cliente_id in (select cliente_id from orphans))
              group by cliente_id having min(cliente_id_limpio) is not null"""
            for name, cond in (
                ("before", f"fecha_venta < date '{CONOCIDO_HASTA}'"),
                ("now", _recent),
            )
        },
    ),
    "upsert_ventas": _hoy("select * from v36"),
    "scd2_tipo": _scd2(
        "cliente_id_limpio || '-' || cast(anio as varchar) || '-' || cast(mes as varchar)",
        ["cliente_id_limpio", "anio", "mes", "tipo_cliente"],
        ["tipo_cliente"],
        "states",
        close_missing=False,
    ),
    "scd2_mayoristas": _scd2(
        "ambito || '-' || cliente_id_limpio",
        ["ambito", "cliente_id_limpio", "nivel_mayorista", "puntaje"],
        ["nivel_mayorista", "puntaje"],
        "wholesale",
        close_missing=True,
    ),
    "check_not_null": _hoy(
        "select * from ("
        + " union all ".join(
            f"select '{c}' as columna, count(*) - count({c}) as nulos from sales"
            for c in (
                "cliente_id",
                "producto_id",
                "pdv_id",
                "fecha_venta",
                "venta_gs",
                "unidades",
                "timbrado",
                "factura_nro",
            )
        )
        + ") where nulos > 0"
    ),
    "check_unique": _hoy(
        """select cliente_id_limpio, count(*) as repeticiones from normalized
        where cliente_id_limpio is not null group by cliente_id_limpio having count(*) > 1"""
    ),
    "check_accepted": _hoy(
        """select pdv_id, count(*) as filas from sales
        where pdv_id not in (select pdv_id from branches) group by pdv_id"""
    ),
    "check_suite": _hoy("select * from (" + " union all ".join(_suite()) + ") where fallas > 0", _MERGED),
    "lineas_descartadas": _hoy(
        f"""select case when m.cliente_id is null then 'sin_id_limpio'
            when m.cliente_id_limpio = '{CLIENTE_PRUEBA}' then 'cliente_prueba'
            when p.producto_id is null then 'producto_excluido' else 'elegible' end as regla,
          cast(count(*) as bigint) as lineas
        from sales s left join mapping m on m.cliente_id = s.cliente_id
        left join (select producto_id from products where id_empresa = 3
          and not {_like_ci_ai('categoria_2', 'bolsa')} and not {_like_ci_ai('categoria_1', 'egre')}
          and not {_like_ci_ai('categoria_1', 'servi')}
          and producto_id not in (select producto_id from excluded)) p on p.producto_id = s.producto_id
        where s.cliente_id is not null group by 1"""
    ),
    "check_schema": _hoy(
        " union all ".join(
            f"""select '{ds}' as tabla, '{c}' as columna, '{want}' as tipo_esperado, {have} as tipo_real,
              (select count(*) from {src} where cliente_id is not null) as filas"""
            for ds, src, c, want, have in [
                ("stg_ventas", "sales", "unidades", "int", "'double'"),
                ("stg_ventas", "sales", "alta", "date", "null"),
                ("stg_clientes", "customers", "mail", "int", "'string'"),
                ("stg_clientes", "customers", "alta", "date", "null"),
            ]
        )
    ),
    "check_collisions": _hoy("select * from merged where cantidad_ids_origen > 1", _MERGED),
    "check_freshness": _hoy(
        """select 1 as ventas_desactualizada from (select max(fecha_venta) as d from sales)
        where d < date '2001-09-30'"""
    ),
    "profile_ids": _hoy(
        f"""select count(*) as total_ids, count(*) filter (cliente_id like '%-%') as con_guion,
          count(*) filter (cliente_id like '%*%') as con_asterisco,
          count(*) filter (cliente_id like '%-%' and cliente_id like '%*%') as con_guion_y_asterisco,
          count(*) filter ({_OTHER}) as con_otros_caracteres,
          count(*) filter ({_stripped('cliente_id')} = '') as queda_vacio_tras_limpiar from raw_ids""",
        _RAW_IDS,
    ),
    "profile_samples": _hoy(
        " union all ".join(
            f"""(select cliente_id, {_stripped('cliente_id')} as cliente_id_clean, '{name}' as anomalia
              from raw_ids where {cond} order by cliente_id limit 50)"""
            for name, cond in (
                ("otro_caracter", _OTHER),
                ("guion_y_asterisco", "cliente_id like '%-%' and cliente_id like '%*%'"),
                ("queda_vacio", f"{_stripped('cliente_id')} = ''"),
            )
        ),
        _RAW_IDS,
    ),
    "collision_histogram": _hoy(
        """select cantidad_ids_origen, count(*) as cantidad_de_clientes_con_esa_cantidad
        from merged group by cantidad_ids_origen""",
        _MERGED,
    ),
    "compare_mappings": _hoy(
        """select count(*) as total_filas_comparadas,
          count(*) filter (cliente_id_limpio_nuevo is null) as conteo_solo_legacy,
          count(*) filter (cliente_id_limpio_legacy is null) as conteo_solo_nuevo,
          count(*) filter (cliente_id_limpio_legacy <> cliente_id_limpio_nuevo) as conteo_valor_distinto
        from compared""",
        _COMPARED,
    ),
    "compare_mappings_solo_legacy": _hoy(
        "select cliente_id, cliente_id_limpio_legacy from compared where cliente_id_limpio_nuevo is null", _COMPARED
    ),
    "compare_mappings_solo_nuevo": _hoy(
        "select cliente_id, cliente_id_limpio_nuevo from compared where cliente_id_limpio_legacy is null", _COMPARED
    ),
    "compare_mappings_valor_distinto": _hoy(
        "select * from compared where cliente_id_limpio_legacy <> cliente_id_limpio_nuevo", _COMPARED
    ),
    "orphan_ids": _hoy("select * from orphans"),
    "orphan_share": _hoy(
        """select tipo_cliente, count(*) as total_eventos,
          count(*) filter (cliente_id_limpio in (select * from unregistered)) as huerfanos,
          count(*) filter (cliente_id_limpio in (select * from unregistered))::double / count(*) as pct_huerfano
        from events group by tipo_cliente""",
        {
            "unregistered": """select cliente_id_limpio from mapping group by cliente_id_limpio
              having count(*) = count(*) filter (cliente_id in (select cliente_id from orphans))"""
        },
    ),
    "multi_id_share": _hoy(
        """select tipo_cliente, count(*) as total_eventos,
          count(*) filter (cantidad_ids_origen > 1) as con_dedup_multi,
          count(*) filter (cantidad_ids_origen > 1)::double / count(*) as pct_con_dedup_multi
        from events left join merged using (cliente_id_limpio)
        where tipo_cliente in ('Nuevo - Dual', 'Nuevo - Unico') group by tipo_cliente""",
        _MERGED,
    ),
    "branches_per_raw_id": _hoy(
        """select n as sucursales_distintas, count(*) as cantidad_cliente_id_crudos from (
          select cliente_id_limpio, cliente_id_crudo, count(distinct sucursal) as n from seen group by all)
        group by n""",
        _MERGED,
    ),
    "branches_per_raw_id_sample": _hoy(
        """select c.cliente_id_limpio, local_origen, local_destino, anio, mes, cliente_id_crudo, sucursal
        from candidates c join seen s on s.cliente_id_limpio = c.cliente_id_limpio
        order by c.cliente_id_limpio, cliente_id_crudo, sucursal, local_origen, local_destino, anio, mes limit 10""",
        _MERGED,
    ),
}



def _meses_corregidos() -> str:
    antes, hoy = params(AS_OF_PREVIO), params()
    wrong = f"date_trunc('month', fecha_venta) = date '{CORREGIDO}'"

    def by_month(amount: str, cond: str) -> str:
        return f"""select cast(year(fecha_venta) * 100 + month(fecha_venta) as int) as periodo, count(*) as n,
          {_money(amount)} as total from eligible where {cond} group by 1"""

    known = f"""fecha_venta >= date '{antes.inicio_ventana(36)}' and fecha_venta < date '{CONOCIDO_HASTA}'
      and not ({wrong} and pdv_id = '4')"""
    now = f"fecha_venta >= date '{hoy.inicio_ventana(36)}' and fecha_venta < date '{hoy.corte}'"
    return _con(
        _BASE,
        f"""select n.periodo, k.n is distinct from n.n or k.total is distinct from n.total as refrescado
        from ({by_month('venta_gs', now)}) n
        left join ({by_month(f"case when {wrong} and pdv_id = '3' then 2 * venta_gs else venta_gs end", known)}) k
          on k.periodo = n.periodo""",
    )


def _etiqueta_en_fecha() -> str:
    """The label of the latest snapshot up to the date that holds the customer-month."""
    ctes = {**_HOY, **_ctes(FOTOS[0], "_a"), **_ctes(FOTOS[1], "_b")}
    shots = " union all ".join(
        f"select timestamp '{day} 06:00:00' as taken, cliente_id_limpio as c, anio as y, mes as m, tipo_cliente as label from states{tag}"
        for day, tag in zip(FOTOS, ("_a", "_b", ""), strict=True)
    )
    ctes["shots"] = shots
    ctes["asked"] = f"""select cliente_id_limpio, anio, mes, local_destino, tipo_cliente as tipo_evento,
      cast(make_date(anio, mes, 1) + interval {MESES_CONSULTA} month as timestamp) as fecha_consulta from events"""
    return _con(
        ctes,
        """select a.*, (select arg_max(label, taken) from shots
             where c = a.cliente_id_limpio and y = a.anio and m = a.mes and taken <= a.fecha_consulta) as tipo_cliente
           from asked a""",
    )


_EXPORT = {
    "export": """select case when n % 103 = 0 then null else cliente_id end as cliente_id,
        case when n % 211 = 0 then null else producto_id end as producto_id,
        case when n % 89 = 0 then strftime(fecha_venta, '%d/%m/%Y') else cast(fecha_venta as varchar) end as fecha_venta,
        case when n % 97 = 0 then cast(cast(unidades as int) as varchar) || ',50' else cast(venta_gs as varchar) end as venta_gs,
        case when n % 101 = 0 then 'n/a' when n % 107 = 0 then '' else cast(unidades as varchar) end as unidades
      from (select *, cast(factura_nro as bigint) as n from sales)""",
    "judged": """select *, cliente_id is null as b1, producto_id is null as b2, try_cast(fecha_venta as date) is null as b3,
        try_cast(venta_gs as double) is null as b4, try_cast(unidades as double) is null as b5 from export""",
}
_GOOD = "not (b1 or b2 or b3 or b4 or b5)"

ORACLE_SQL |= {
    "rechazos": _con(
        {"sales": _BASE["sales"], **_EXPORT},
        " union all ".join(
            f"select '{rule}' as regla, {col} as columna, count(*) as filas from judged where {bad} having count(*) > 0"
            for rule, col, bad in [
                ("aceptada", "null", _GOOD),
                ("requerida", "'cliente_id'", "b1"),
                ("requerida", "'producto_id'", "b2"),
                ("tipo:date", "'fecha_venta'", "b3"),
                ("tipo:double", "'venta_gs'", "b4"),
                ("tipo:double", "'unidades'", "b5"),
            ]
        ),
    ),
    "ventas_aceptadas": _con(
        {"sales": _BASE["sales"], **_EXPORT},
        f"""select cast(year(d) * 100 + month(d) as int) as periodo, count(*) as lineas,
          {_money('try_cast(unidades as double)')} as unidades
        from (select *, try_cast(fecha_venta as date) as d from judged where {_GOOD}) group by 1""",
    ),
    "ventas_por_nivel": _hoy(
        " union all ".join(
            f"""select '{level}' as nivel, {pdv} as pdv_id, {prod} as producto_id, count(*) as lineas,
              {_money('unidades')} as unidades, {_money('venta_gs')} as venta_gs
            from (select * replace (nullif(pdv_id, '4') as pdv_id) from v12) {by}"""
            for level, pdv, prod, by in [
                ("pdv_producto", "pdv_id", "producto_id", "group by pdv_id, producto_id"),
                ("pdv", "pdv_id", "null", "group by pdv_id"),
                ("producto", "null", "producto_id", "group by producto_id"),
                ("total", "null", "null", ""),
            ]
        )
    ),
    "publicar_correcciones": ORACLE_SQL["ventas_36m"],
    "meses_corregidos": _meses_corregidos(),
    "publicar_mapeo_fusionado": _con(
        _BASE,
        f"""select cliente_id, min(cliente_id_limpio) as cliente_id_limpio from (
              select cliente_id, cliente_id_limpio from normalized union all
              select cliente_id, {_derived(_trimmed(_stripped('cliente_id')))} from sales
              where fecha_venta < date '{CORRIDAS[-1]}' and cliente_id in (select cliente_id from orphans))
            group by cliente_id having min(cliente_id_limpio) is not null""",
    ),
    "etiqueta_en_fecha": _etiqueta_en_fecha(),
    "ultima_venta_por_id": _hoy(
        """select * exclude (k, fila) from (
          select a.*, s.fecha_venta, s.factura_nro, s.venta_gs, row_number() over (
            partition by k order by s.fecha_venta desc, s.factura_nro desc, s.venta_gs desc) as fila
          from asked a left join sales s on s.cliente_id = a.cliente_id and s.fecha_venta < a.fecha_evento)
        where fila = 1""",
        {
            "asked": """select e.cliente_id_limpio, local_destino, make_date(anio, mes, 1) as fecha_evento,
              m.cliente_id, row_number() over () as k
            from events e join mapping m on m.cliente_id_limpio = e.cliente_id_limpio"""
        },
    ),
    "tipo_migracion_incremental": ORACLE_SQL["tipo_migracion"],
    "top300_meses": ORACLE_SQL["top300_ranking"],
    "publicar_tabla": ORACLE_SQL["top300_ranking"],
    "publicar_ventas_36m": ORACLE_SQL["ventas_36m"],
    "publicar_mapeo": ORACLE_SQL["upsert_mapeo"],
    "publicar_historia_tipo": ORACLE_SQL["scd2_tipo"],
    "publicar_historia_mayoristas": ORACLE_SQL["scd2_mayoristas"],
}
