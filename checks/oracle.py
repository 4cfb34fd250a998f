"""The same results in plain SQL for DuckDB, written over whole joins and windows.

DuckDB rounds a double by its binary value, so rounded results go through a wide decimal. Its month, null order and
integer division differ from Spark's and are written out.
"""

from risklake.sources.schemas import SOURCES


def _rounded(value: str, digits: int) -> str:
    return f"cast(round(cast({value} as decimal(38,12)), {digits}) as double)"


def _percent(part: str, whole: str) -> str:
    return _rounded(f"({part}) * 100.0::double / nullif({whole}, 0)", 2)


def _money(value: str) -> str:
    return f"cast(sum(cast({value} as decimal(18,2))) as double)"


def _defaulted_money(value: str) -> str:
    return f"cast(sum(cast({value} as decimal(18,2))) filter (where status = 'INADIMPLENTE') as double)"


def _cents(value: str) -> str:
    return f"cast(round({value} * 100.0::double, 0) as bigint)"


def _half_up(numerator: str, denominator: str) -> str:
    return f"((2 * ({numerator}) + ({denominator})) // (2 * ({denominator})))"


_SCORE = "300 + cast(floor((c_acctbal + 1000) / 20) as bigint)"
_INSTALMENTS = (
    "(case o_orderkey % 6 when 0 then 6 when 1 then 12 when 2 then 18 when 3 then 24 when 4 then 36 else 48 end)"
)
_RATE = "(cast(800 + (o_orderkey % 7300) as double) / 1000)"
_STATUS = "case o_orderstatus when 'P' then 'INADIMPLENTE' when 'O' then 'ATIVO' else 'QUITADO' end"
_EVENT = (
    "case event_type when 'click' then 'ATRASO_30' when 'view' then 'ATRASO_60' when 'error' then 'ATRASO_90' "
    "when 'purchase' then 'CALOTE' else upper(event_type) end"
)
_QUOTE = _half_up(
    f"{_cents('o_totalprice')} * (100800 + o_orderkey % 7300)", f"100000 * cast({_INSTALMENTS} as bigint)"
)


def _score_band(score: str) -> str:
    return (
        f"case when {score} >= 750 then 'BAIXO' when {score} >= 600 then 'MEDIO' "
        f"when {score} >= 500 then 'ALTO' else 'MUITO_ALTO' end"
    )


def _income_band(income: str) -> str:
    return (
        f"case when {income} >= 10000 then 'ALTA' when {income} >= 5000 then 'MEDIA' "
        f"when {income} >= 2000 then 'BAIXA' else 'MUITO_BAIXA' end"
    )


def _severity(kind: str) -> str:
    return (
        f"cast(case {kind} when 'ATRASO_30' then 1 when 'ATRASO_60' then 2 when 'ATRASO_90' then 3 "
        f"when 'CALOTE' then 4 else 0 end as bigint)"
    )


_CLEAN = f"""
with clientes as (
  select c_custkey as cliente_id, trim(c_name) as nome, {_SCORE} as score_credito,
         case when c_custkey % 50 = 0 then null else c_acctbal * 1.5 end as renda_mensal,
         n_name as estado, {_score_band(_SCORE)} as faixa_risco
  from customer join nation on c_nationkey = n_nationkey
), emprestimos as (
  select o_orderkey as emprestimo_id, o_custkey as cliente_id, o_totalprice as valor_emprestado,
         cast({_INSTALMENTS} as bigint) as num_parcelas, {_RATE} as taxa_juros,
         cast(o_orderdate as date) as data_concessao, {_STATUS} as status,
         cast({_QUOTE} as double) / 100 as valor_parcela
  from orders
), pagamentos as (
  select l_orderkey as emprestimo_id, cast(l_linenumber as bigint) as parcela_num,
         cast(l_shipdate as date) as data_vencimento, l_extendedprice as valor_devido,
         case when l_linestatus = 'O' and l_returnflag = 'N' then null
              else cast(l_shipdate as date) + cast((l_partkey % 94) - 3 as integer) end as data_pagamento,
         case when l_linestatus = 'O' and l_returnflag = 'N' then null
              else cast((l_partkey % 94) - 3 as double) end as dias_atraso
  from lineitem
), eventos as (
  select event_id as evento_id, user_id as cliente_id, {_severity(_EVENT)} as severidade from events
)
"""

_BY_STATE = f"""
select estado, count(distinct emprestimo_id) as total_emprestimos,
       count(distinct emprestimo_id) filter (where status = 'INADIMPLENTE') as inadimplentes,
       {_percent("count(distinct emprestimo_id) filter (where status = 'INADIMPLENTE')",
                 "count(distinct emprestimo_id)")} as taxa_inadimplencia_pct,
       coalesce({_defaulted_money("valor_emprestado")}, 0) as valor_em_risco
from emprestimos join clientes using (cliente_id)
group by estado
"""

_BY_SCORE = f"""
select faixa_risco, {_rounded("avg(score_credito)", 0)} as score_medio,
       count(distinct cliente_id) as total_clientes, count(distinct emprestimo_id) as total_emprestimos,
       count(distinct emprestimo_id) filter (where status = 'INADIMPLENTE') as inadimplentes,
       {_rounded("cast(sum(cast(taxa_juros as decimal(18,6))) as double) / count(taxa_juros)", 2)} as taxa_juros_media,
       {_rounded(_money("valor_emprestado") + " / count(valor_emprestado)", 2)} as ticket_medio,
       {_percent("count(distinct emprestimo_id) filter (where status = 'INADIMPLENTE')",
                 "count(distinct emprestimo_id)")} as taxa_inadimplencia_pct
from clientes join emprestimos using (cliente_id)
group by faixa_risco
"""

_RANKED = f"""
select cliente_id, nome, score_credito, faixa_risco, estado, total_emprestimos,
       cast(emprestado as double) as valor_total_emprestado, cast(inadimplente as double) as valor_inadimplente,
       total_eventos_risco, maior_severidade, rank() over (order by inadimplente desc) as ranking_exposicao,
       {_percent("cast(inadimplente as double)", "cast(emprestado as double)")} as pct_inadimplente
from exposicao where inadimplente > 0
"""

# ---- parsing ----

_MOMENT = (
    "^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])"
    "([ T]+[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)? *(Z|[+-][0-9]{2}:[0-9]{2})?)? *$"
)


def _integer(text: str) -> str:
    digits = f"try_cast(regexp_extract({text}, '^[ \\t]*([+-]?[0-9]{{1,38}})', 1) as hugeint)"
    return (
        f"case when ({text}) is not null then cast(greatest(least(coalesce({digits}, 0), 9223372036854775807), "
        f"-9223372036854775808) as bigint) end"
    )


def _real(text: str) -> str:
    number = f"regexp_extract({text}, '^[ \\t]*([+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?)', 1)"
    return f"case when ({text}) is not null then coalesce(try_cast({number} as double), 0) end"


def _utc(text: str) -> str:
    """Moment in UTC as a timestamp without zone: the written clock less its offset."""
    offset = f"regexp_extract({text}, '([+-])([0-9]{{2}}):([0-9]{{2}}) *$'"
    minutes = f"(cast({offset}, 2) as integer) * 60 + cast({offset}, 3) as integer))"
    bare = f"replace(regexp_replace(trim({text}), '( *Z| *[+-][0-9]{{2}}:[0-9]{{2}})$', ''), 'T', ' ')"
    whole = f"try_cast({bare} as timestamp)"
    shifted = (
        f"case when {offset}, 1) = '' then {whole} "
        f"when {offset}, 1) = '-' then {whole} + to_minutes({minutes}) else {whole} - to_minutes({minutes}) end"
    )
    return f"case when regexp_matches({text}, '{_MOMENT}') then {shifted} end"


def _date(text: str) -> str:
    return f"strftime(cast({_utc(text)} as date), '%Y-%m-%d')"


def _julian(text: str) -> str:
    """Julian day of a moment; days count on from the first of the month, and hour 24 from midnight."""
    beyond = (
        f"cast(substr({text}, 1, 7) || '-01' as timestamp) + to_days(cast(substr({text}, 9, 2) as integer) - 1) "
        f"+ to_hours(if({text} like '% 24:00', 24, 0))"
    )
    odd = f"regexp_matches({text}, '^[0-9]{{4}}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])( 24:00)?$')"
    return f"(cast(epoch_ms(case when {odd} then {beyond} else {_utc(text)} end) + 210866760000000 as double) / 86400000)"


def _fixed(amount: str) -> str:
    return f"cast(cast({amount} as decimal(18,2)) as varchar)"


# ---- raw text ----

_BORN = "(date '1950-01-01' + cast(floor(c_acctbal + 1000) as integer))"
_BORN_TEXT = f"strftime({_BORN}, '%Y-%m-%d')"
_KEY11 = "lpad(cast(c_custkey as varchar), 11, '0')"
_SCORE_TEXT = f"cast({_SCORE} as varchar)"
_PAID_TEXT = "strftime(cast(l_shipdate as date) + cast((l_partkey % 94) - 3 as integer), '%Y-%m-%d')"
_RAW_EVENT = _EVENT.replace("upper(event_type)", "'OUTRO'")

_RAW = f"""
with bronze_clientes as (
  select case when c_nationkey <> 3 then cast(c_custkey as varchar) end as cliente_id,
         '  ' || c_name || ' ' as nome,
         case when c_nationkey <> 4 then substr({_KEY11}, 1, 3) || '.' || substr({_KEY11}, 4, 3) || '.' ||
              substr({_KEY11}, 7, 3) || '-' || substr({_KEY11}, 10, 2) end as cpf,
         case c_nationkey when 5 then strftime({_BORN}, '%d/%m/%Y') when 6 then {_BORN_TEXT} || ' 23:30:00-03:00'
              when 7 then ' ' || {_BORN_TEXT} when 8 then {_BORN_TEXT} || 'T10:15' else {_BORN_TEXT}
         end as data_nascimento,
         case when c_nationkey = 9 then null else case c_mktsegment when 'FURNITURE' then ' ' || {_SCORE_TEXT}
              when 'MACHINERY' then {_SCORE_TEXT} || ',5' when 'BUILDING' then 'nota ' || {_SCORE_TEXT}
              else {_SCORE_TEXT} end end as score_credito,
         case when c_nationkey = 10 then null else case c_mktsegment
              when 'FURNITURE' then replace({_fixed("c_acctbal")}, '.', ',')
              when 'MACHINERY' then 'R$ ' || {_fixed("c_acctbal")} else {_fixed("c_acctbal")} end
         end as renda_mensal,
         ' ' || lower(n_name) || ' ' as estado, {_BORN_TEXT} as data_cadastro
  from customer join nation on c_nationkey = n_nationkey
), bronze_emprestimos as (
  select cast(o_orderkey as varchar) as emprestimo_id,
         case when o_orderpriority <> '1-URGENT' then cast(o_custkey as varchar) end as cliente_id,
         {_fixed("o_totalprice")} as valor_emprestado,
         case when o_orderpriority = '2-HIGH' then replace({_fixed("o_totalprice")}, '.', ',')
              else {_fixed("o_totalprice")} end as valor_parcela,
         cast(o_orderkey as varchar) || '.9 x' as num_parcelas, substr(o_orderpriority, 1, 1) || '.25%' as taxa_juros,
         cast(o_orderdate as varchar) as data_concessao,
         case when o_orderpriority = '5-LOW' then ' ' || lower({_STATUS}) || ' ' else {_STATUS} end as status
  from orders
), bronze_pagamentos as (
  select case when l_tax <> 0.08 then concat_ws('-', l_orderkey, l_linenumber, l_partkey) end as pagamento_id,
         cast(l_orderkey as varchar) as emprestimo_id, cast(l_linenumber as varchar) as parcela_num,
         strftime(l_shipdate, '%Y-%m-%d') as data_vencimento,
         case when l_linestatus = 'O' and l_returnflag = 'N' then null
              when l_linestatus = 'F' and l_returnflag = 'N' then 'em aberto'
              when l_linenumber = 6 then substr({_PAID_TEXT}, 1, 8) || '31'
              when l_linenumber = 5 then {_PAID_TEXT} || ' 24:00'
              when l_returnflag = 'R' then {_PAID_TEXT} || ' 12:00' else {_PAID_TEXT} end as data_pagamento,
         {_fixed("l_extendedprice")} as valor_devido,
         case when l_returnflag = 'A' then {_fixed("l_extendedprice")} || ' BRL' else {_fixed("l_discount")} end
         as valor_pago,
         case when l_returnflag = 'N' then ' pendente ' else 'Pago' end as status
  from lineitem
), bronze_eventos_risco as (
  select case when value >= 1 then cast(event_id as varchar) end as evento_id,
         cast(user_id as varchar) as cliente_id, cast(event_id as varchar) as emprestimo_id,
         case when value > 20 then ' ' || lower({_RAW_EVENT}) || ' ' else {_RAW_EVENT} end as tipo_evento,
         strftime(ts, '%Y-%m-%d %H:%M') as data_evento, {_fixed("value")} as valor_em_risco
  from events
)
"""

_KEPT = {
    "clientes": "cliente_id is not null and score_credito is not null and cpf is not null",
    "emprestimos": "emprestimo_id is not null and cliente_id is not null "
    "and status in ('ATIVO', 'QUITADO', 'INADIMPLENTE')",
    "pagamentos": "pagamento_id is not null",
    "eventos_risco": "evento_id is not null",
}

SILVER = {
    "silver_clientes": _RAW
    + f"""
select cliente_id, trim(nome) as nome, replace(cpf, '.', '') as cpf, {_date("data_nascimento")} as data_nascimento,
       {_integer("score_credito")} as score_credito, {_real("renda_mensal")} as renda_mensal,
       upper(trim(estado)) as estado, {_date("data_cadastro")} as data_cadastro,
       {_score_band(f"({_integer('score_credito')})")} as faixa_risco,
       {_income_band(f"({_real('renda_mensal')})")} as faixa_renda
from bronze_clientes where {_KEPT["clientes"]}
""",
    "silver_emprestimos": _RAW
    + f"""
select emprestimo_id, cliente_id, {_real("valor_emprestado")} as valor_emprestado,
       {_real("valor_parcela")} as valor_parcela, {_integer("num_parcelas")} as num_parcelas,
       {_real("taxa_juros")} as taxa_juros, {_date("data_concessao")} as data_concessao, status,
       ({_real("valor_parcela")}) * ({_integer("num_parcelas")}) as valor_total,
       ({_real("valor_parcela")}) * ({_integer("num_parcelas")}) - ({_real("valor_emprestado")}) as custo_credito
from bronze_emprestimos where {_KEPT["emprestimos"]}
""",
    "silver_pagamentos": _RAW
    + f"""
select pagamento_id, emprestimo_id, parcela_num, {_date("data_vencimento")} as data_vencimento,
       {_date("data_pagamento")} as data_pagamento, {_real("valor_devido")} as valor_devido,
       {_real("valor_pago")} as valor_pago, upper(trim(status)) as status,
       {_julian("data_pagamento")} - {_julian("data_vencimento")} as dias_atraso,
       ({_real("valor_pago")}) - ({_real("valor_devido")}) as diferenca_valor
from bronze_pagamentos where {_KEPT["pagamentos"]}
""",
    "silver_eventos_risco": _RAW
    + f"""
select evento_id, cliente_id, emprestimo_id, upper(trim(tipo_evento)) as tipo_evento,
       {_date("data_evento")} as data_evento, {_real("valor_em_risco")} as valor_em_risco,
       {_severity("tipo_evento")} as severidade
from bronze_eventos_risco where {_KEPT["eventos_risco"]}
""",
}

GOLD = {
    "gold_inadimplencia_por_estado": _CLEAN + _BY_STATE,
    "gold_evolucao_inadimplencia": _CLEAN
    + f""", mensal as (
  select strftime(data_concessao, '%Y-%m') as mes, count(*) as total,
         count(*) filter (where status = 'INADIMPLENTE') as inadimplentes,
         coalesce({_defaulted_money("valor_emprestado")}, 0) as valor_inadimplente
  from emprestimos group by 1
), vizinhos as (
  select *, lag(inadimplentes) over (order by mes nulls first) as inadimplentes_mes_anterior from mensal
)
select *, {_percent("inadimplentes", "total")} as taxa_pct,
       inadimplentes - inadimplentes_mes_anterior as variacao_absoluta,
       {_percent("inadimplentes - inadimplentes_mes_anterior", "inadimplentes_mes_anterior")} as variacao_pct
from vizinhos
""",
    "gold_ranking_risco_clientes": _CLEAN
    + """, exposicao as (
  select c.cliente_id, nome, score_credito, faixa_risco, estado, count(e.emprestimo_id) as total_emprestimos,
         sum(cast(valor_emprestado as decimal(18,2))) as emprestado,
         sum(cast(valor_emprestado as decimal(18,2))) filter (where status = 'INADIMPLENTE') as inadimplente,
         count(v.evento_id) as total_eventos_risco, max(severidade) as maior_severidade
  from clientes c
  left join emprestimos e on e.cliente_id = c.cliente_id
  left join eventos v on v.cliente_id = c.cliente_id
  group by all
)"""
    + _RANKED,
    "ranking_exposicao_corrigido": _CLEAN
    + """, exposicao as (
  select c.cliente_id, nome, score_credito, faixa_risco, estado,
         (select count(*) from emprestimos e where e.cliente_id = c.cliente_id) as total_emprestimos,
         (select sum(cast(valor_emprestado as decimal(18,2))) from emprestimos e where e.cliente_id = c.cliente_id)
           as emprestado,
         (select sum(cast(valor_emprestado as decimal(18,2))) from emprestimos e
          where e.cliente_id = c.cliente_id and status = 'INADIMPLENTE') as inadimplente,
         (select count(*) from eventos v where v.cliente_id = c.cliente_id) as total_eventos_risco,
         (select max(severidade) from eventos v where v.cliente_id = c.cliente_id) as maior_severidade
  from clientes c
)"""
    + _RANKED,
    "gold_risco_por_score": _CLEAN + _BY_SCORE,
    "gold_alerta_risco_iminente": _CLEAN
    + f""", historico as (
  select cliente_id, count(*) filter (where dias_atraso > 0) as qtd_atrasos, max(dias_atraso) as maior_atraso,
         sum(dias_atraso) filter (where dias_atraso > 0) as dias
  from emprestimos join pagamentos using (emprestimo_id)
  group by cliente_id
), ativos as (
  select cliente_id, {_money("valor_emprestado")} as exposicao_total
  from emprestimos where status = 'ATIVO' group by cliente_id
)
select cliente_id, nome, score_credito, faixa_risco, estado, qtd_atrasos, maior_atraso,
       {_rounded("dias / qtd_atrasos", 1)} as media_atraso, exposicao_total,
       {_rounded("qtd_atrasos * 10 + (case when maior_atraso > 60 then 30 when maior_atraso > 30 then 15 else 5 end)"
                 " + (850 - score_credito) / 20.0::double", 1)} as score_risco_composto
from clientes join ativos using (cliente_id) join historico using (cliente_id)
where qtd_atrasos > 0
""",
    "preview_top5_estados": _CLEAN + _BY_STATE + "order by taxa_inadimplencia_pct desc, estado limit 5",
    "preview_risco_por_score": _CLEAN
    + "select faixa_risco, score_medio, total_emprestimos, inadimplentes, taxa_inadimplencia_pct from ("
    + _BY_SCORE
    + ")",
}


def _numbers(columns: dict[str, str]) -> str:
    parts = [f"{_integer(v)} as {k}_inteiro, {_real(v)} as {k}_real" for k, v in columns.items()]
    return "select o_orderkey as chave, " + ", ".join(parts) + " from orders"


_ORDER = "cast(o_orderkey as varchar)"
_AMOUNT = _fixed("o_totalprice")
_ISO = "strftime(o_orderdate, '%Y-%m-%d')"
_DATES = {
    "iso": _ISO,
    "espaco_antes": f"' ' || {_ISO}",
    "espaco_depois": f"{_ISO} || '  '",
    "relogio": f"{_ISO} || ' 10:30'",
    "zulu": f"{_ISO} || 'T23:59:59.999Z'",
    "fuso": f"{_ISO} || ' 23:30:00-03:00'",
    "fuso_leste": f"{_ISO} || 'T01:30:00 +02:00'",
    "barra": "strftime(o_orderdate, '%d/%m/%Y')",
    "curta": f"regexp_replace({_ISO}, '-0', '-', 'g')",
    "mes_treze": f"regexp_replace({_ISO}, '-[0-9]{{2}}-', '-13-')",
    "dia_31": f"substr({_ISO}, 1, 8) || '31'",
    "hora_24": f"{_ISO} || ' 24:00'",
    "prioridade": "o_orderpriority",
}
_DATES = {name: f"({text})" for name, text in _DATES.items()}
_KIND = f"(case when value >= 1 then {_EVENT} end)"
_WRITTEN = f"(case when value > 20 then lower({_KIND}) else {_KIND} end)"

def _csv() -> str:
    """All raw columns; the last one in quotes, with a separator, and with a line break for clients."""
    parts = []
    for name, source in SOURCES.items():
        *others, last = source.columns
        mark = "'\"; '" if name != "clientes" else "chr(10) || '\"'"
        shown = [f"coalesce({c}, '<nulo>')" for c in others] + [f"coalesce(' \"' || {last} || {mark}, '<nulo>')"]
        parts.append(
            f"select '{name}' as tabela, {others[0]} as chave, concat_ws('|', {', '.join(shown)}) as linha from bronze_{name}"
        )
    return _RAW + " union all ".join(parts)


#: columns of the views in their order; doubles, which are compared in hundredths, with a star
_VIEW_COLUMNS = {
    "gold_inadimplencia_por_estado": "estado total_emprestimos inadimplentes taxa_inadimplencia_pct* valor_em_risco*",
    "gold_evolucao_inadimplencia": "mes total inadimplentes taxa_pct* valor_inadimplente* inadimplentes_mes_anterior "
    "variacao_absoluta variacao_pct*",
    "gold_ranking_risco_clientes": "cliente_id nome score_credito faixa_risco estado total_emprestimos "
    "valor_total_emprestado* valor_inadimplente* total_eventos_risco maior_severidade ranking_exposicao pct_inadimplente*",
    "gold_risco_por_score": "faixa_risco score_medio* total_clientes total_emprestimos inadimplentes taxa_juros_media* "
    "ticket_medio* taxa_inadimplencia_pct*",
    "gold_alerta_risco_iminente": "cliente_id nome score_credito faixa_risco estado qtd_atrasos maior_atraso* media_atraso* "
    "exposicao_total* score_risco_composto*",
}


def _refreshed() -> str:
    """The views over the tables cleaned in SQL, and the size of every table with its rows that have an ingest time."""
    clean = "".join(
        f", {alias} as ({SILVER['silver_' + name][len(_RAW) :]})"
        for name, alias in zip(_KEPT, ("clientes", "emprestimos_texto", "pagamentos", "eventos"))
    )
    clean += (
        ", emprestimos as (select * replace (try_cast(data_concessao as date) as data_concessao) from emprestimos_texto)"
    )
    parts = []
    for name, columns in _VIEW_COLUMNS.items():
        body = GOLD[name][len(_CLEAN) :].strip()
        body = f"with {body[1:]}" if body.startswith(",") else body
        shown = [
            f"coalesce(cast(cast(round({c[:-1]} * 100) as decimal(38,0)) as varchar), '<nulo>')"
            if c.endswith("*")
            else f"coalesce(cast({c} as varchar), '<nulo>')"
            for c in columns.split()
        ]
        parts.append(f"select '{name}' as tabela, concat_ws('|', {', '.join(shown)}) as linha from ({body})")
    for name, kept in _KEPT.items():
        parts.append(f"select 'bronze_{name}', count(*) || '|' || count(*) from bronze_{name}")
        parts.append(f"select 'silver_{name}', count(*) || '|0' from bronze_{name} where {kept}")
    return _RAW.rstrip() + clean + " " + " union all ".join(parts)


SMALL = {
    "parse_inteiro_real": _numbers(
        {
            "inteiro_virgula": f"({_ORDER} || ',50')",
            "branco": f"(' ' || chr(9) || {_AMOUNT})",
            "sinal": f"('-' || {_AMOUNT} || 'abc')",
            "expoente": f"({_AMOUNT} || 'e2')",
            "milhar": f"({_ORDER} || '.' || {_ORDER} || ',00')",
            "lixo": f"('R$ ' || {_AMOUNT})",
            "longo": f"('99999999999999999999' || {_ORDER})",
            "palavra": "o_orderstatus",
        }
    ),
    "parse_data": "select o_orderkey as chave, "
    + ", ".join(f"{_date(text)} as {name}" for name, text in _DATES.items())
    + f", {_julian(_DATES['fuso'])} - {_julian(_DATES['iso'])} as dias_fuso"
    + f", {_julian(_DATES['relogio'])} - {_julian(_DATES['zulu'])} as dias_relogio"
    + f", {_julian(_DATES['barra'])} - {_julian(_DATES['iso'])} as dias_barra"
    # fixed rules, not the parser: the 31st lies 31 - day days on, hour 24 one day
    + ", cast(31 - day(o_orderdate) as double) as dias_31, 1.0::double as dias_24 from orders",
    "limpeza_texto": """
select o_orderkey as chave, upper(trim('  ' || lower(o_orderpriority) || ' ')) as codigo,
       'SãO ' || o_orderstatus || chr(9) as acento, '123' || o_orderkey || '789-01' as documento
from orders
""",
    "na_tokens": """
select event_id as chave, event_type as tipo,
       case when event_type in ('click', 'error') then null when event_type = 'view' then ' NA '
            when value > 20 then null else '-' end as texto
from events
""",
    "lookup_severidade": f"""
select event_id as chave, {_WRITTEN} as tipo, {_severity(_WRITTEN)} as severidade from events
""",
    "faixas_score_renda": _CLEAN
    + f""", parcial as (
  select cliente_id, case when estado <> 'BRAZIL' then score_credito end as score, renda_mensal from clientes
)
select *, {_score_band("score")} as faixa_risco, {_income_band("renda_mensal")} as faixa_renda from parcial
""",
    "filtro_status_bruto": _RAW
    + f"select status, count(*) as linhas from bronze_emprestimos where {_KEPT['emprestimos']} group by status",
    "auditoria_contagens": _RAW
    + " union all ".join(
        [f"select 'bronze_{name}' as tabela, count(*) as registros from bronze_{name}" for name in _KEPT]
        + [f"select 'silver_{name}', count(*) from bronze_{name} where {kept}" for name, kept in _KEPT.items()]
    ),
    "csv_ida_e_volta": _csv(),
    "carga_completa": _refreshed(),
    "rank_global_distribuido": """
with linhas as (
  select l_orderkey as emprestimo_id, cast(l_linenumber as bigint) as parcela_num,
         case when l_returnflag = 'R' then l_quantity
              when l_returnflag = 'A' or l_linestatus = 'F' then l_extendedprice end as valor
  from lineitem
)
select *, rank() over (order by valor desc nulls last) as posicao from linhas
""",
    # as text, which is read as the nearest double
    "soma_exata": """
with centavos as (select *, cast(round(o_totalprice * 100) as bigint) as c from orders)
select o_custkey as cliente_id, cast(cast(sum(
         case o_orderkey % 4 when 0 then cast(c as decimal(38,11)) * 0.01::decimal(2,2)
              when 1 then cast(1000000000000000 + c as decimal(38,11)) when 2 then cast(-1000000000000000 - c as decimal(38,11))
              else cast(c as decimal(38,11)) * 0.000000001::decimal(9,9) end) as varchar) as double) as total
from centavos group by o_custkey
""",
    "juncao_chave_quente": """
select o_orderkey as emprestimo_id, if(o_orderkey % 3 = 0, 1, o_custkey) as cliente_id, c_acctbal as saldo
from orders left join customer on c_custkey = if(o_orderkey % 3 = 0, 1, o_custkey)
""",
    "score_limitado": """
select c_custkey as cliente_id,
       case when c_mktsegment = 'BUILDING' then null when floor(c_acctbal / 10) < 300 then 300
            when floor(c_acctbal / 10) > 850 then 850 else cast(floor(c_acctbal / 10) as bigint) end as score_credito
from customer
""",
    "politica_preco": _CLEAN
    + """, faixas(baixo, alto, taxa_min, taxa_max, valor_min, valor_max) as (
  values (750, 99999, 0.8::double, 1.5::double, 5000, 50000), (600, 750, 1.5::double, 3.5::double, 1000, 20000),
         (-99999, 600, 3.5::double, 8.0::double, 500, 8000)
)
select emprestimo_id, cliente_id, score_credito, taxa_juros, valor_emprestado / 50 as valor_emprestado,
       taxa_juros < taxa_min or taxa_juros > taxa_max as taxa_fora,
       valor_emprestado / 50 < valor_min or valor_emprestado / 50 > valor_max as valor_fora
from emprestimos join clientes using (cliente_id)
join faixas on score_credito >= baixo and score_credito < alto
""",
    "cotacao_parcela": _CLEAN
    + """
select emprestimo_id, valor_parcela as parcela_cotada, num_parcelas <> 12 as confere from emprestimos
""",
    "probabilidades_risco": _CLEAN
    + """
select cliente_id, score_credito, faixa_risco, greatest(20, 700 - score_credito) / 1000::double as prob_inadimplencia,
       greatest(40, 700 - score_credito) / 800::double as prob_atraso
from clientes
""",
    "perda_esperada": _CLEAN
    + f"""
select faixa_risco, count(*) as total_emprestimos, {_money("valor_emprestado")} as valor_total,
       cast(sum(cast(valor_emprestado as decimal(18,2)) * cast(greatest(20, 700 - score_credito) as decimal(4,0)))
            as double) / 1000 as perda_esperada
from emprestimos join clientes using (cliente_id) group by faixa_risco
""",
    "cronograma_parcelas": _CLEAN
    + """, parcelas as (
  select *, unnest(range(1, num_parcelas + 1)) as parcela_num from emprestimos
), vencimentos as (
  select *, data_concessao + cast(30 * parcela_num as integer) as vence from parcelas
)
select emprestimo_id, cliente_id, parcela_num, strftime(vence, '%Y-%m-%d') as data_vencimento,
       valor_parcela as valor_devido
from vencimentos where vence <= date '2000-01-01'
""",
    "multa_atraso": _CLEAN
    + f"""
select emprestimo_id, parcela_num, strftime(data_vencimento, '%Y-%m-%d') as data_vencimento,
       strftime(data_pagamento, '%Y-%m-%d') as data_pagamento, valor_devido,
       case when dias_atraso > 0 then 'ATRASADO' when dias_atraso <= 0 then 'PAGO' end as status_apurado,
       case when dias_atraso > 0 then cast({_half_up(_cents("valor_devido") + " * 102", "100")} as double) / 100
            when dias_atraso <= 0 then valor_devido end as valor_apurado
from pagamentos
""",
}


def oracle_sql() -> dict[str, str]:
    return {**SILVER, **GOLD, **SMALL}
