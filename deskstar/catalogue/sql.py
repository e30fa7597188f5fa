"""SQL building blocks of the twins: the bound tickets and feeds, the curated layer, the star.

Written from the definitions, not from the Spark code; where an engine differs (regular expression
dialect, means of decimals) the SQL uses its own formulation.
"""

from __future__ import annotations

import re


def strip(x: str) -> str:
    space = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
    return f"regexp_replace({x}, '^{space}+|{space}+$', '', 'g')"


def collapse(x: str) -> str:
    return rf"regexp_replace({x}, '[\s\x0b\x1c-\x1f\x85\p{{Z}}]+', ' ', 'g')"


def text(x: str) -> str:
    return f"coalesce({strip(x)}, '')"


def hours(created: str, updated: str) -> str:
    d = f"(epoch_us({updated}) - epoch_us({created}))"
    return (
        f"CASE WHEN {d} >= 0 THEN CAST((({d} * 100 + 1800000000) // 3600000000) / 100.0 "
        f"AS DECIMAL(12,2)) END"
    )


def mean2(total: str, n: str) -> str:
    """Half-up mean to two decimals of a non-negative two-decimal total, in integer arithmetic."""
    cents = f"CAST(({total}) * 100 AS HUGEINT)"
    return (
        f"CASE WHEN ({n}) > 0 THEN CAST(((2 * {cents} + ({n})) // (2 * ({n}))) / 100.0 AS DECIMAL(14,2)) END"
    )


def case(key: str, pairs: dict, otherwise: str) -> str:
    def lit(v) -> str:
        return str(v) if isinstance(v, int) else "'" + v + "'"

    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in pairs.items())
    return f"CASE {key} {whens} ELSE {otherwise} END"


STATUS = {1: "Aberto", 2: "Resolvido", 3: "Aguardando o cliente", 4: "Em Execução", 5: "Fechado",
          6: "Aguardando terceiros", 7: "Em análise", 8: "Fechamento automático"}
COMPANY = {0: "AAA", 1: "BBB", 2: "CCC", 3: "DDD"}

STATUS_SQL = f"CASE WHEN status IS NULL THEN 'Outros' ELSE {case('status', STATUS, repr('Outros'))} END"
STATUS_LEGACY_SQL = (
    "CASE WHEN status = 2 THEN 'aberto' WHEN status = 5 THEN 'fechado' "
    "WHEN status BETWEEN 1 AND 8 THEN 'outros' ELSE '' END"
)
COMPANY_SQL = case(
    "company_id", COMPANY,
    "CASE " + " ".join(f"WHEN regexp_matches(subject, '(?i)\\b{c}\\b') THEN '{c}'" for c in COMPANY.values())
    + " ELSE '' END",
)
COMPANY_LEGACY_SQL = "CASE company_id WHEN 0 THEN 'AAA' WHEN 1 THEN 'BBB' WHEN 2 THEN 'CCC' ELSE '' END"


def kind(subject: str = "subject") -> str:
    s = f"lower({text(subject)})"
    return (
        f"CASE WHEN contains({s}, 'csi') THEN 'CSI' WHEN contains({s}, 'crise') THEN 'CRISE' "
        f"WHEN contains({s}, 'checklist') OR contains({s}, 'health check') OR contains({s}, 'server summary') "
        f"THEN 'Checklist' WHEN contains({s}, 'incidente') OR starts_with({s}, 'alert:') "
        f"OR starts_with({s}, 'clear:') OR contains({s}, 'alerta de restart') THEN 'Incidente' ELSE 'Outros' END"
    )


def kind_legacy(declared: str = "type", subject: str = "subject") -> str:
    s, d = f"lower({text(subject)})", f"lower({text(declared)})"
    return (
        f"CASE WHEN {d} = 'csi' THEN 'CSI' WHEN {d} = 'checklist' THEN 'Checklist' "
        f"WHEN {d} IN ('incidente', 'incidentes') THEN 'Incidentes' WHEN {d} = 'crise' THEN 'CRISE' "
        f"WHEN starts_with({s}, 'csi') THEN 'CSI' "
        f"WHEN contains({s}, 'checklist') OR contains({s}, 'health check') OR contains({s}, 'server summary') "
        f"THEN 'Checklist' WHEN starts_with({s}, 'alert:') OR starts_with({s}, 'clear:') "
        f"OR contains({s}, 'alerta de restart') THEN 'Incidentes' ELSE {d} END"
    )


def _prefixes(s: str, customers: str) -> str:
    for p in (r"(INFO([\s\p{Z}]+[\pL\pN_]+)?)[\s\p{Z}]*:[\s\p{Z}]*", r"(ALERT|CLEAR)[\s\p{Z}]*:[\s\p{Z}]*",
              rf"({customers})[\s\p{{Z}}]*-[\s\p{{Z}}]*"):
        s = f"regexp_replace({s}, '(?i)^{p}', '')"
    return s


def title(subject: str, kind_sql: str, customers: str = "AAA|BBB|CCC|DDD") -> str:
    s = text(subject)
    return strip(collapse(f"CASE WHEN {kind_sql} = 'CSI' THEN {s} ELSE {_prefixes(s, customers)} END"))


def title_legacy(subject: str, kind_sql: str, customers: str = "AAA|BBB") -> str:
    s = text(subject)
    return f"CASE WHEN lower({kind_sql}) = 'csi' THEN {s} ELSE {strip(_prefixes(s, customers))} END"


def csi_gate(status: str, kind_sql: str) -> str:
    return f"CASE WHEN upper({kind_sql}) = 'CSI' THEN {text(status)} ELSE 'na' END"


def dbms(field: str, subject: str) -> str:
    s = f"upper({text(subject)})"
    return (
        f"CASE WHEN {text(field)} <> '' THEN upper({text(field)}) WHEN contains({s}, 'ORACLE') THEN 'ORACLE' "
        f"WHEN contains({s}, 'SQL SERVER') OR contains({s}, 'SQLSERVER') THEN 'SQL SERVER' "
        f"WHEN contains({s}, 'POSTGRES') THEN 'POSTGRESQL' WHEN contains({s}, 'MYSQL') THEN 'MYSQL' "
        f"WHEN contains({s}, 'MONGO') THEN 'MONGODB' ELSE '' END"
    )


def environment(c: str) -> str:
    u = f"upper({text(c)})"
    return (
        f"CASE WHEN {u} IN ('PRD','PROD','PRODUCAO','PRODUÇÃO') THEN 'Produção' "
        f"WHEN {u} IN ('HML','HOMOLOG','HOMOLOGACAO','HOMOLOGAÇÃO') THEN 'Homologação' "
        f"WHEN {u} IN ('DEV','DESENV','DESENVOLVIMENTO') THEN 'Desenvolvimento' "
        f"WHEN {u} IN ('TESTE','TESTES','QA') THEN 'Teste' WHEN {u} IN ('OUTRO','OUTROS') THEN 'Outro' "
        f"ELSE {text(c)} END"
    )


def macro(c: str) -> str:
    t = f"lower({text(c)})"
    return f"CASE WHEN {t} = '' THEN NULL WHEN contains({t}, 'prod') THEN 'Produção' ELSE 'Não Produção' END"


def instance(subject: str) -> str:
    return f"upper({strip(f'regexp_extract({text(subject)}, {chr(39)}\\(([^)]+)\\){chr(39)}, 1)')})"


def server(subject: str) -> str:
    """First valid candidate over all matches of all patterns, concatenated in priority order."""
    s, name = text(subject), r"([A-Z0-9._\-]+)"
    # RE2 word boundaries are ASCII: an explicit non-letter class in front covers accents.
    edge = r"(?:^|[^\pL\pN_])"
    words = ["Server", "Host", "Servidor", "Inst[aâ]ncia", "Database", "DB"]
    sp = r"[\s\p{Z}]*"
    patterns = [rf"(?i){edge}{w}{sp}[:\-]{sp}{name}" for w in words]
    patterns += [rf"(?i)^([A-Z0-9._\-]{{5,}}){sp}-{sp}", rf"(?i)-{sp}([A-Z0-9._\-]{{5,}}){sp}\("]
    found = "[]::VARCHAR[]"
    for p in patterns:
        found = f"list_concat({found}, regexp_extract_all({s}, '{p}', 1))"
    ok = r"length(x) >= 5 AND regexp_matches(x, '[0-9._\-]')"
    return f"coalesce(list_extract([upper(x) for x in {found} if {ok}], 1), '')"


CTES = {
    "ev": """SELECT event_id, ts, user_id, event_type,
        CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events""",
    # Tickets, one row per id.
    "bt": """SELECT event_id AS id, user_id % 6 AS company_id,
        CASE event_type
          WHEN 'error' THEN 'ALERT: Server: ' || printf('SRV-%03d', user_id % 40) || ' (DB' || (k % 7) || ') Oracle down'
          WHEN 'signup' THEN 'CSI -  melhoria  INSTÂNCIA: ' || printf('SRV-%03d', user_id % 40)
          WHEN 'purchase' THEN 'INFO daily: Health Check BBB (db' || (k % 7) || ')'
          WHEN 'click' THEN printf('SRV-%03d', user_id % 40) || ' - crise no postgres'
          ELSE 'AAA - pedido geral' END AS subject,
        CASE WHEN k % 10 = 9 THEN NULL ELSE k % 10 END AS status, k % 4 + 1 AS priority,
        CASE k % 7 WHEN 0 THEN 'csi' WHEN 1 THEN ' Checklist ' WHEN 2 THEN 'Incidente' WHEN 3 THEN 'incidentes'
          WHEN 4 THEN 'CRISE' WHEN 5 THEN 'Pedido' END AS type,
        ts AS created_at,
        CASE WHEN k % 17 <> 0 THEN ts + to_minutes((k - 20) * 37) END AS updated_at,
        CASE WHEN k % 5 = 0 THEN 'Oracle' END AS cf_sgdb,
        CASE k % 6 WHEN 0 THEN 'prd' WHEN 1 THEN 'HML' WHEN 2 THEN 'qa' WHEN 3 THEN 'Outros' WHEN 5 THEN 'Lab' END AS cf_ambiente,
        CASE WHEN event_type = 'signup' THEN CASE k % 4 WHEN 0 THEN ' Implementado ' WHEN 1 THEN 'Aberto' WHEN 2 THEN 'NA' END END AS cf_csi_status,
        CAST(date_trunc('month', ts) AS DATE) + CAST(((day(ts) - 1) // 7) * 7 AS INTEGER) AS window_start,
        1 AS page, event_id AS pos FROM ev""",
    "pages_landed": """SELECT * FROM bt UNION ALL
        SELECT id, company_id, subject, 5 AS status, priority, type, created_at, updated_at, cf_sgdb, cf_ambiente,
        cf_csi_status, window_start, 2 AS page, pos FROM bt WHERE id % 50 = 0""",
    "subj": """SELECT 'ticket' AS origem, id, subject FROM bt UNION ALL SELECT 'documento', doc_id, text FROM documents
        UNION ALL SELECT 'conversa', conv_id * 1000 + turn, text FROM conversations""",
    "typed": f"SELECT *, {kind()} AS tipo_ticket, {server('subject')} AS srv, {instance('subject')} AS inst FROM bt",
    "curated": f"""SELECT id AS id_ticket, {COMPANY_SQL} AS empresa, strftime(created_at, '%Y-%m-%d') AS data_criacao,
        strftime(updated_at, '%Y-%m-%d') AS data_ultima_alteracao, tipo_ticket, {STATUS_SQL} AS status_ticket,
        CASE WHEN updated_at > created_at THEN 'sim' ELSE 'nao' END AS foi_atuado,
        {title('subject', 'tipo_ticket')} AS titulo_ticket, {csi_gate('cf_csi_status', 'tipo_ticket')} AS csi_status,
        {dbms('cf_sgdb', 'subject')} AS sgdb, {environment('cf_ambiente')} AS ambiente,
        CASE WHEN srv <> '' THEN srv ELSE inst END AS nome_servidor, inst AS instancia,
        CASE WHEN srv <> '' THEN srv ELSE inst END AS nk_servidor,
        {hours('created_at', 'updated_at')} AS tempo_resolucao_horas, window_start, page, pos FROM typed""",
    "legacy_typed": f"SELECT *, {kind_legacy()} AS tipo_ticket FROM bt",
    "legacy": f"""SELECT id AS id_ticket, {COMPANY_LEGACY_SQL} AS empresa,
        coalesce(strftime(created_at, '%Y-%m-%d'), '') AS data_criacao,
        coalesce(strftime(updated_at, '%Y-%m-%d'), '') AS data_ultima_alteracao, tipo_ticket,
        {STATUS_LEGACY_SQL} AS status_ticket,
        CASE WHEN updated_at > created_at THEN 'sim' ELSE 'não' END AS foi_atuado,
        {title_legacy('subject', 'tipo_ticket')} AS titulo_ticket,
        CASE WHEN tipo_ticket = 'CSI' AND cf_csi_status IS NOT NULL THEN lower({text('cf_csi_status')}) ELSE 'na' END AS csi_status
        FROM legacy_typed""",
    # Monitoring feeds.
    "lm": """SELECT printf('SRV-%03d', l_suppkey) AS instancia,
        CAST((year(l_shipdate) + 28) * 100 + month(l_shipdate) AS INTEGER) AS anomes, l_quantity, l_returnflag FROM lineitem""",
    "sz": """SELECT instancia, anomes, (anomes // 100) * 12 + anomes % 100 AS mi,
        CAST(sum(l_quantity) AS DECIMAL(14,2)) AS tamanho_gb FROM lm WHERE l_returnflag IN ('A', 'N') GROUP BY ALL""",
    "vol": """SELECT a.instancia, a.anomes, a.tamanho_gb, CAST(a.tamanho_gb - b1.tamanho_gb AS DECIMAL(15,2)) AS delta_1_mes,
        CAST(a.tamanho_gb - b2.tamanho_gb AS DECIMAL(15,2)) AS delta_2_meses,
        CAST(a.tamanho_gb - b3.tamanho_gb AS DECIMAL(15,2)) AS delta_3_meses,
        CAST(a.tamanho_gb - b6.tamanho_gb AS DECIMAL(15,2)) AS delta_6_meses,
        CAST(a.tamanho_gb - b12.tamanho_gb AS DECIMAL(15,2)) AS delta_12_meses
        FROM sz a LEFT JOIN sz b1 ON b1.instancia = a.instancia AND b1.mi = a.mi - 1
        LEFT JOIN sz b2 ON b2.instancia = a.instancia AND b2.mi = a.mi - 2
        LEFT JOIN sz b3 ON b3.instancia = a.instancia AND b3.mi = a.mi - 3
        LEFT JOIN sz b6 ON b6.instancia = a.instancia AND b6.mi = a.mi - 6
        LEFT JOIN sz b12 ON b12.instancia = a.instancia AND b12.mi = a.mi - 12""",
    "disp": """SELECT instancia, anomes, CAST(100 - count(*) % 5 AS DOUBLE) AS disponibilidade_pct,
        CAST(count(*) * 11 AS INTEGER) AS minutos_indisponiveis FROM lm WHERE l_returnflag = 'R' GROUP BY ALL""",
    "srv_staging": """SELECT coalesce(v.instancia, d.instancia) AS instancia, coalesce(v.instancia, d.instancia) AS host_name,
        coalesce(v.anomes, d.anomes) AS anomes, CAST(v.tamanho_gb AS DOUBLE) AS tamanho_gb, CAST(v.delta_1_mes AS DOUBLE) AS delta_1_mes,
        CAST(NULL AS DOUBLE) AS delta_2_meses, CAST(v.delta_3_meses AS DOUBLE) AS delta_3_meses,
        CAST(v.delta_6_meses AS DOUBLE) AS delta_6_meses, CAST(v.delta_12_meses AS DOUBLE) AS delta_12_meses,
        d.disponibilidade_pct, d.minutos_indisponiveis
        FROM vol v FULL JOIN disp d ON v.instancia = d.instancia AND v.anomes = d.anomes""",
    # The star, with keys of its own.
    "days": """SELECT CAST(data_criacao AS DATE) AS d FROM curated WHERE data_criacao IS NOT NULL
        UNION SELECT CAST(data_ultima_alteracao AS DATE) FROM curated WHERE data_ultima_alteracao IS NOT NULL
        UNION SELECT make_date(CAST(anomes // 100 AS INTEGER), CAST(anomes % 100 AS INTEGER), 1) FROM srv_staging""",
    "dim_tempo": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS sk_tempo, d AS data_completa,
        CAST(strftime(d, '%Y%m') AS INTEGER) AS anomes FROM days""",
    "dim_cliente": """SELECT row_number() OVER (ORDER BY nm_cliente) AS sk_cliente, nm_cliente FROM
        (SELECT DISTINCT CASE WHEN empresa = '' THEN 'NÃO IDENTIFICADO' ELSE empresa END AS nm_cliente FROM curated)""",
    "dim_tipo_ticket": """SELECT row_number() OVER (ORDER BY nm_tipo_ticket) AS sk_tipo_ticket, nm_tipo_ticket FROM
        (SELECT DISTINCT tipo_ticket AS nm_tipo_ticket FROM curated)""",
    "dim_status_ticket": """SELECT row_number() OVER (ORDER BY nm_status_ticket) AS sk_status_ticket, nm_status_ticket FROM
        (SELECT DISTINCT status_ticket AS nm_status_ticket FROM curated)""",
    "dim_status_csi": """SELECT row_number() OVER (ORDER BY nm_status_csi) AS sk_status_csi, nm_status_csi FROM
        (SELECT DISTINCT lower(csi_status) AS nm_status_csi FROM curated WHERE csi_status <> '')""",
    "ticket_servers": f"""SELECT nk_servidor, nullif(instancia, '') AS instancia, nome_servidor, ambiente,
        {macro('ambiente')} AS ambiente_macro, sgdb, empresa FROM (SELECT *, row_number() OVER (PARTITION BY nk_servidor
        ORDER BY empresa, ambiente, sgdb, nome_servidor, window_start, page, pos) AS n FROM curated
        WHERE nk_servidor <> '' AND nome_servidor <> '') WHERE n = 1""",
    "feed_servers": "SELECT DISTINCT instancia FROM srv_staging",
    "dim_servidor": """SELECT row_number() OVER (ORDER BY nk_servidor) AS sk_servidor, * FROM (
        SELECT t.nk_servidor, coalesce(t.instancia, f.instancia) AS instancia, f.instancia AS host_name, t.nome_servidor,
          t.ambiente, t.ambiente_macro, t.sgdb, c.sk_cliente
        FROM ticket_servers t LEFT JOIN feed_servers f ON f.instancia = t.nk_servidor
        LEFT JOIN dim_cliente c ON c.nm_cliente = t.empresa
        UNION ALL SELECT instancia, instancia, instancia, instancia, NULL, NULL, NULL, NULL FROM feed_servers
        WHERE instancia NOT IN (SELECT nk_servidor FROM ticket_servers))""",
    "fato_ticket": """SELECT id_ticket AS id_ticket_origem, c.sk_cliente, s.sk_servidor, t.sk_tipo_ticket, st.sk_status_ticket,
        d1.sk_tempo AS sk_tempo_criacao, d2.sk_tempo AS sk_tempo_ultima_alt,
        CAST(CASE foi_atuado WHEN 'sim' THEN 1 ELSE 0 END AS SMALLINT) AS foi_atuado, tempo_resolucao_horas, titulo_ticket,
        TIMESTAMP '2024-02-01 00:00:00' AS data_carga
        FROM curated q LEFT JOIN dim_cliente c ON c.nm_cliente = CASE WHEN q.empresa = '' THEN 'NÃO IDENTIFICADO' ELSE q.empresa END
        LEFT JOIN dim_servidor s ON s.nk_servidor = q.nk_servidor LEFT JOIN dim_tipo_ticket t ON t.nm_tipo_ticket = q.tipo_ticket
        LEFT JOIN dim_status_ticket st ON st.nm_status_ticket = q.status_ticket
        LEFT JOIN dim_tempo d1 ON d1.data_completa = CAST(q.data_criacao AS DATE)
        LEFT JOIN dim_tempo d2 ON d2.data_completa = CAST(q.data_ultima_alteracao AS DATE)""",
    "fato_csi": """SELECT id_ticket AS id_ticket_origem, c.sk_cliente, s.sk_servidor, sc.sk_status_csi, d1.sk_tempo AS sk_tempo_criacao,
        d2.sk_tempo AS sk_tempo_fechamento, titulo_ticket AS titulo_csi,
        CAST(CASE foi_atuado WHEN 'sim' THEN 1 ELSE 0 END AS SMALLINT) AS foi_atuado, tempo_resolucao_horas,
        TIMESTAMP '2024-02-01 00:00:00' AS data_carga
        FROM curated q LEFT JOIN dim_cliente c ON c.nm_cliente = q.empresa LEFT JOIN dim_servidor s ON s.nk_servidor = q.nk_servidor
        JOIN dim_status_csi sc ON sc.nm_status_csi = lower(q.csi_status)
        JOIN dim_tempo d1 ON d1.data_completa = CAST(q.data_criacao AS DATE)
        LEFT JOIN dim_tempo d2 ON d2.data_completa = CAST(q.data_ultima_alteracao AS DATE)
        WHERE tipo_ticket = 'CSI'""",
    "fato_servidor": """SELECT s.sk_servidor, anomes * 100 + 1 AS sk_tempo_referencia, CAST(tamanho_gb AS DECIMAL(14,2)) AS tamanho_gb,
        CAST(delta_1_mes AS DECIMAL(14,2)) AS delta_1_mes, CAST(delta_2_meses AS DECIMAL(14,2)) AS delta_2_meses,
        CAST(delta_3_meses AS DECIMAL(14,2)) AS delta_3_meses, CAST(delta_6_meses AS DECIMAL(14,2)) AS delta_6_meses,
        CAST(delta_12_meses AS DECIMAL(14,2)) AS delta_12_meses, CAST(disponibilidade_pct AS DECIMAL(7,2)) AS disponibilidade_pct,
        minutos_indisponiveis FROM srv_staging v JOIN dim_servidor s ON s.nk_servidor = v.instancia""",
    "map_servidor_instancia": """SELECT DISTINCT instancia, 'SRV-00' || substr(instancia, 3, 1) AS host_name FROM dim_servidor
        WHERE regexp_full_match(instancia, 'DB[0-9]')""",
}

_NAME = re.compile(r"\b(?:FROM|JOIN|IN \(SELECT \w+ FROM)\s+(\w+)")


def _needs(sql: str) -> list[str]:
    return [n for n in dict.fromkeys(_NAME.findall(sql)) if n in CTES]


def with_ctes(body: str, **extra: str) -> str:
    """The body preceded by the building blocks it uses, in dependency order."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in _needs(sql):
            if name not in order:
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    for sql in (*extra.values(), body):
        visit(sql)
    parts = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in order] + [f"{n} AS ({s})" for n, s in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
