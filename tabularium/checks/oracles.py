"""The SQL that each registered query must agree with, written apart from the operators."""

from __future__ import annotations

from tabularium.checks import inputs
from tabularium.checks.queries import CHOSEN_ACTIVITIES, COUNTED_ACTIVITIES, INDEX_BASE
from tabularium.layouts import ESTABLISHMENT_FIELDS

_COUNTED = ", ".join(f"'{code}'" for code in COUNTED_ACTIVITIES)
_CHOSEN = ", ".join(f"'{code}'" for code in CHOSEN_ACTIVITIES)


def _with(**parts: str) -> str:
    named = ",\n".join(f"{name} as ({inputs.in_oracle(sql)})" for name, sql in parts.items())
    return f"with {named}\n"


def _facts(*fields: str) -> str:
    return _with(f1=inputs.establishments_sql(*fields))


def _strict(field: str) -> str:
    return (
        f"case when regexp_full_match({field}, '\\d{{8}}')"
        f" then cast(try_strptime({field}, '%Y%m%d') as date) end"
    )


def _legacy(field: str) -> str:
    return (
        f"case when regexp_matches({field}, '^\\d{{6}}0*[1-9]\\d?([^0-9]|$)') then"
        f" cast(try_strptime(substr({field}, 1, 6) ||"
        f" lpad(regexp_extract({field}, '^\\d{{6}}0*([1-9]\\d?)', 1), 2, '0'), '%Y%m%d')"
        " as date) end"
    )


def _line(*fields: str) -> str:
    """A delimited line, every field quoted, missing ones as well."""
    return " || ';' || ".join(f"""'"' || coalesce(cast({name} as varchar), '') || '"'""" for name in fields)


_STATUS = """case f1.cd_situacao_cadastral when '01' then 'Nula' when '02' then 'Ativa'
    when '03' then 'Suspensa' when '04' then 'Inapta' else 'Baixada' end"""
_BRANCH = "case when f1.cd_matriz_filial = 1 then 'Matriz' else 'Filial' end"

_TYPED = "select * replace (try_cast(numero as int) as numero) from f1"

_SILVER = f"""select cnpj_basico, cnpj_ordem, cnpj_dv,
    cnpj_basico || cnpj_ordem || cnpj_dv as cnpj,
    cd_matriz_filial, {_BRANCH} as matriz_filial, nome_fantasia,
    cd_situacao_cadastral, {_STATUS} as situacao_cadastral,
    {_legacy("data_situacao_cadastral")} as data_situacao_cadastral,
    cd_motivo_situacao_cadastral, r.descricao as motivo_situacao_cadastral,
    nome_cidade_exterior, PLACE_COUNTRY,
    {_legacy("data_inicio_atividades")} as data_inicio_atividades,
    cd_cnae_fiscal, a.descricao as cnae_fiscal, cd_cnae_fiscal_secundario,
    tipo_logradouro, logradouro, try_cast(numero as int) as numero, complemento, bairro, cep, uf,
    PLACE_MUNICIPALITY, ddd1, telefone1, ddd2, telefone2, ddd_fax, fax, correio_eletronico,
    cd_situacao_especial, {_legacy("data_situacao_especial")} as data_situacao_especial
from f1 left join r on cd_motivo_situacao_cadastral = r.codigo
    left join a on cd_cnae_fiscal = a.codigo"""

_SILVER_35 = _SILVER.replace("PLACE_COUNTRY", "pais").replace("PLACE_MUNICIPALITY", "municipio")
_SILVER_37 = (
    _SILVER.replace("PLACE_COUNTRY", "pais as cd_pais, c.descricao as pais").replace(
        "PLACE_MUNICIPALITY", "municipio as cd_municipio, m.descricao as municipio"
    )
    + " left join c on f1.pais = c.codigo left join m on f1.municipio = m.codigo"
)
_SILVER_PARTS = {
    "f1": inputs.establishments_sql(),
    "r": inputs.REASONS_SQL,
    "a": inputs.ACTIVITIES_SQL,
}
_DOCUMENTED_PARTS = _SILVER_PARTS | {"c": inputs.COUNTRIES_SQL, "m": inputs.MUNICIPALITIES_SQL}


def _dates(parse) -> str:
    names = ("data_situacao_cadastral", "data_inicio_atividades", "data_situacao_especial")
    parsed = ", ".join(f"{parse(name)} as {name}" for name in names)
    return f"{_facts('id', *names)} select id, {parsed} from f1"


def _lookup(field: str, table: str, code: str, label: str) -> str:
    return (
        _with(f1=inputs.establishments_sql("id", field), d=table)
        + f"select id, {field} as {code}, d.descricao as {label}"
        f" from f1 left join d on f1.{field} = d.codigo"
    )


_COUNTRY = _lookup("pais", inputs.COUNTRIES_SQL, "cd_pais", "pais")

# The pages hold no unquoted href, no character reference in one and no unclosed quote.
_EXTRACT_LINKS = r"""
with seen as (
  select page_id, regexp_replace(html,
    '(?is)<!--.*?-->|<script[\s/>].*?</script\s*>|<style[\s/>].*?</style\s*>', '', 'g') as html
  from pages),
found as (
  select page_id, regexp_extract_all(html,
    '(?i)<a\s(?:[^>"'']|"[^"]*"|''[^'']*'')*?\bhref\s*=\s*["'']([^"'']*)["'']', 1) as links
  from seen)
select page_id, cast(i - 1 as int) as pos, links[i] as href
from (select page_id, links, unnest(range(1, len(links) + 1)) as i from found)"""

# A day in the newest month on each index page.
_NEWEST_DAY = """select o_orderkey as page_id, cast(o_orderdate as date)
    + cast(case when o_orderkey % 3 = 2 then 0 else 40 end as int) as d from orders"""

_WANTED = """href like '%.zip' and (lower(href) like '%cnaes%'
    or lower(href) like '%motivos%' or lower(href) like '%estabelecimentos%')"""

ORACLES: dict[str, str] = {
    "flagship_silver": _with(**_SILVER_PARTS) + _SILVER_35,
    "silver_documented": _with(**_DOCUMENTED_PARTS) + _SILVER_37,
    "silver_cut_codes": _with(**_DOCUMENTED_PARTS) + _SILVER_37,
    "silver_shuffled_codes": _with(**_DOCUMENTED_PARTS) + _SILVER_37,
    "silver_filtered": f"{_with(**_SILVER_PARTS)} {_SILVER_35} where cd_cnae_fiscal in ({_CHOSEN})",
    "archive_to_silver": _with(**_SILVER_PARTS) + _SILVER_35,
    "csv_fact_read": _facts() + _TYPED,
    "csv_code_table": inputs.in_oracle(inputs.REASONS_SQL),
    "csv_code_table_latin1": inputs.in_oracle(inputs.ACTIVITIES_SQL),
    "csv_multi_file": _facts() + _TYPED,
    "csv_permissive_int": _facts("cep", "cd_matriz_filial", "numero") + _TYPED,
    "parquet_overwrite": _facts() + _TYPED,
    "parquet_by_state": _with(**_SILVER_PARTS) + _SILVER_35,
    "parquet_by_code": _with(**_SILVER_PARTS) + _SILVER_35,
    "parquet_publish": _with(**_SILVER_PARTS) + _SILVER_35,
    "silver_pruned": f"""{_with(**_SILVER_PARTS)} select * from ({_SILVER_35})
        where uf = 'SP' and cd_cnae_fiscal between '0000100' and '0000400'""",
    "silver_counts": f"""{_with(**_DOCUMENTED_PARTS)}, s as ({_SILVER_37} where cd_cnae_fiscal in ({_COUNTED}))
        select 'rows_read' as name, count(*) as n from f1
        union all select 'rows_written', count(*) from s
        union all select 'unmatched_cd_motivo_situacao_cadastral', count(*) from s
            where cd_motivo_situacao_cadastral is not null and motivo_situacao_cadastral is null
        union all select 'unmatched_cd_cnae_fiscal', count(*) from s
            where cd_cnae_fiscal is not null and cnae_fiscal is null
        union all select 'unmatched_cd_pais', count(*) from s where cd_pais is not null and pais is null
        union all select 'unmatched_cd_municipio', count(*) from s
            where cd_municipio is not null and municipio is null""",
    "archive_integrity": _with(f1=inputs.establishments_sql("id", *ESTABLISHMENT_FIELDS))
    + f"""select 'Estabelecimentos' || n || '.zip' as file_name, 'Estabelecimentos' as entity,
            case when n % 4 <> 1 then cast(2 as bigint) end as members,
            case when n % 4 <> 1 then cast(sum(octet_length(encode(line)) + 1) + 14 as bigint) end as bytes,
            case n % 4 when 1 then 'directory' when 2 then n || '.csv: content' end as fault
        from (select cast(id % {inputs.FRAGILE} as int) as n, {_line(*ESTABLISHMENT_FIELDS)} as line from f1)
        group by n""",
    "archive_distinct": _with(f1=inputs.establishments_sql(), r=inputs.REASONS_SQL)
    + f"""select 'Estabelecimentos' as entity, {_line(*ESTABLISHMENT_FIELDS)} as line from f1
        union all select 'Motivos', {_line("codigo", "descricao")} from r""",
    "csv_mixed_encodings": inputs.in_oracle(inputs.ACTIVITIES_SQL),
    "csv_rejects": _with(lines=inputs.PLANTED_LINES_SQL)
    + """, orders_by_id as (
            select o_orderkey as id, 'C' || o_custkey as o_clerk, o_orderpriority, cast(o_orderkey as int) as key from orders)
        select case n when 4 then '"' || o_clerk || '";1;"' || o_orderpriority || '"' else o_clerk end as name,
            cast(case n when 1 then null when 4 then key when 6 then 7 when 7 then null
                when 2 then 1 when 3 then 1 when 5 then 1 else key end as int) as number,
            case n when 4 then 'z' when 6 then null when 0 then o_orderpriority || '; A'
                when 1 then o_orderpriority when 2 then o_orderpriority when 3 then o_orderpriority
                when 5 then o_orderpriority when 7 then o_orderpriority else o_orderpriority || '; A' end as city,
            cast(case when n in (4, 6, 7) then null else key end as int) as key,
            case when n in (2, 4, 6) then null else 'z' end as mark,
            case when n between 1 and 7 then line end as line,
            case n when 1 then 'value:number' when 2 then 'short' when 3 then 'long' when 4 then 'short'
                when 5 then 'quote' when 6 then 'value:key' when 7 then 'value:key' else '' end as faults,
            n between 1 and 7 as faulty
        from lines join orders_by_id using (id)""",
    "archive_expand": _with(r=inputs.REASONS_SQL, a=inputs.ACTIVITIES_SQL)
    + "select 'Motivos' as entity, * from r union all select 'Cnaes' as entity, * from a",
    "archive_extract": _with(f1=inputs.establishments_sql(), r=inputs.REASONS_SQL, a=inputs.ACTIVITIES_SQL)
    + f"""select 'Estabelecimentos' as entity, {_line(*ESTABLISHMENT_FIELDS)} as value from f1
        union all select 'Motivos', {_line("codigo", "descricao")} from r
        union all select 'Cnaes', {_line("codigo", "descricao")} from a""",
    "row_count": "select count(*) as n from orders",
    "preview": f"{_facts()} {_TYPED} order by cep limit 20",
    "full_id": _facts("id", "cnpj_basico", "cnpj_ordem", "cnpj_dv")
    + "select id, cnpj_basico || cnpj_ordem || cnpj_dv as cnpj from f1",
    "branch_label": _facts("id", "cd_matriz_filial")
    + f"select id, cd_matriz_filial, {_BRANCH} as matriz_filial from f1",
    "status_label": _facts("id", "cd_situacao_cadastral")
    + f"select id, cd_situacao_cadastral, {_STATUS} as situacao_cadastral from f1",
    "date_parse_legacy": _dates(_legacy),
    "date_parse_strict": _dates(_strict),
    "date_parse_ragged": _with(f6=inputs.RAGGED_DATES_SQL)
    + f"select id, {_legacy('s')} as legacy, {_strict('s')} as strict from f6",
    "lookup_reason": _lookup(
        "cd_motivo_situacao_cadastral",
        inputs.REASONS_SQL,
        "cd_motivo_situacao_cadastral",
        "motivo_situacao_cadastral",
    ),
    "lookup_activity": _lookup(
        "cd_cnae_fiscal", inputs.ACTIVITIES_SQL, "cd_cnae_fiscal", "cnae_fiscal"
    ),
    "lookup_fanout": _lookup(
        "cd_motivo_situacao_cadastral",
        f"{inputs.REASONS_SQL} union all {inputs.REASONS_SQL}",
        "cd_motivo_situacao_cadastral",
        "motivo_situacao_cadastral",
    ),
    "lookup_country": _COUNTRY,
    "lookup_municipality": _lookup(
        "municipio", inputs.MUNICIPALITIES_SQL, "cd_municipio", "municipio"
    ),
    "lookup_hot_code": _COUNTRY,
    "filter_activity": f"{_facts()} {_TYPED} where cd_cnae_fiscal in ({_CHOSEN})",
    "extract_links": _EXTRACT_LINKS,
    "latest_snapshot": f"""select page_id, cast(date_trunc('month', d) as date) as snapshot,
        '{INDEX_BASE}' || strftime(d, '%Y-%m') || '/' as snapshot_url from ({_NEWEST_DAY})""",
    "read_pages": "select page_id, html from pages",
    "listing_to_manifest": f"""with pages as (
            select o_orderkey, o_custkey % 100 as site, strftime(cast(o_orderdate as date) + 40, '%Y-%m') as m
            from orders),
        newest as (
            select o_custkey % 100 as site, max(strftime(d, '%Y-%m')) as m
            from ({_NEWEST_DAY}) join orders on page_id = o_orderkey group by 1),
        files as (
            select *, 'Cnaes.zip' as href from pages
            union all
            select *, 'Estabelecimentos' || o_orderkey || '.zip' from pages),
        named as (
            select '{INDEX_BASE}' || site || '/' || m || '/' as snapshot_url, href
            from files semi join newest using (site, m))
        select snapshot_url, href, snapshot_url || href as url, href as file_name from named""",
    "newest_link_by_site": _with(links=inputs.SITE_LINKS_SQL)
    + f"""select site, any_value(snapshot) as snapshot, any_value(url) as snapshot_url
        from (
            select site, cast(null as date) as snapshot, cast(null as varchar) as url from links
            union all
            select site, cast(substr(href, 1, 7) || '-01' as date), '{INDEX_BASE}' || href
            from (select *,
                    row_number() over (partition by site order by substr(href, 1, 7) desc, pos) as n
                from links where href not like '/docs%')
            where n = 1)
        group by site""",
    "manifest_filter": _with(f5=inputs.LINKS_SQL)
    + f"""select link_id, href, '{INDEX_BASE}' || href as url, href as file_name
        from f5 where {_WANTED}""",
    "file_name_entity": _with(f5=inputs.LINKS_SQL)
    + r"select link_id, href as file_name, regexp_replace(href, '\d*\.zip$', '') as entity from f5",
    "load_completeness": _with(
        wanted=inputs.ORDERED_FILES_SQL, landed=inputs.SHIPPED_FILES_SQL
    )
    + """select * from wanted where not exists
        (select 1 from landed where landed.file_name = wanted.file_name)""",
}
