"""Edge rows of the text operators; expectations written by hand."""

from pyspark.sql import functions as F

from deskstar.functions import text

C = F.col


def one(values, texts, fn):
    return values([(t,) for t in texts], "s string", fn(C("s")))


def test_strip_and_key(values):
    assert one(values, ["  a  b\t", " x ", None, "\x1c\n"], text.normalise_text) == ["a  b", "x", "", ""]
    assert one(values, ["  srv  \t01 ", None], text.normalise_key) == ["SRV 01", ""]


def test_blank_to_default(values):
    assert one(values, [" ", None, " a "], lambda c: text.blank_to_default(c, "X")) == ["X", "X", "a"]
    assert one(values, [" ", None, " a "], lambda c: text.blank_to_default(c, None)) == [None, None, "a"]


def test_status_codes(values):
    codes = [1, 2, 3, 4, 5, 6, 7, 8, 0, 99, None]
    labels = ["Aberto", "Resolvido", "Aguardando o cliente", "Em Execução", "Fechado", "Aguardando terceiros",
              "Em análise", "Fechamento automático", "Outros", "Outros", "Outros"]
    assert values([(c,) for c in codes], "s int", text.map_status(C("s"))) == labels
    assert one(values, ["5", " abc ", None], text.map_status) == ["Fechado", "abc", "Outros"]
    legacy = values([(c,) for c in codes], "s int", text.map_status_legacy(C("s")))
    assert legacy == ["outros", "aberto", "outros", "outros", "fechado", "outros", "outros", "outros", "", "", ""]
    assert one(values, [" Aberto ", None], lambda c: text.map_status_legacy(c, numeric=False)) == ["aberto", ""]


def test_company(values):
    rows = [
        (72000664348, "SES x", "MILLS"), (1, "erro na SES hoje", "SES"), (1, "SESÃO", ""), (None, "mills", "MILLS"),
        (1, "SES e MILLS", "MILLS"), (1, "secretaria da saúde", "SES"), (1, "a nossa drogaria", "AND"),
        (1, None, ""), (1, "BRAND", ""),
    ]
    got = values([r[:2] for r in rows], "i bigint, s string", text.map_company(C("i"), C("s")))
    assert got == [r[2] for r in rows]
    ids = [(72000664348,), (72001771221,), (72000835424,), (72000747023,), (5,), (None,)]
    assert values(ids, "i bigint", text.map_company_legacy(C("i"))) == ["MILLS", "SENAC", "AND", "SES", "", ""]


def test_classifier(values):
    rows = {
        "policsix": "CSI", "Crise CSI": "CSI", "clear: x": "Incidente", "x alert:": "Outros", None: "Outros",
        "CRISE no banco": "CRISE", "Health Check": "Checklist", "Server SUMMARY": "Checklist",
        "alerta de restart": "Incidente", "INCIDENTE": "Incidente", "": "Outros",
    }
    assert one(values, list(rows), text.classify_ticket) == list(rows.values())


def test_classifier_legacy(values):
    rows = [("Incidente", "x", "Incidentes"), (" CSI ", "", "CSI"), (None, "csi - x", "CSI"), (None, "tem csi", ""),
            ("Pedido", "ALERT: x", "Incidentes"), ("Pedido", "x", "pedido"), (None, None, "")]
    got = values([r[:2] for r in rows], "t string, s string", text.classify_ticket_legacy(C("t"), C("s")))
    assert got == [r[2] for r in rows]


def test_titles(values):
    rows = [("INFO daily: ALERT: Mills - x  y", "Outros", "x y"), ("CSI:  a \t b", "CSI", "CSI: a b"),
            ("clear : SES - z", "Incidente", "z"), (None, "Outros", ""), ("sem prefixo", "Outros", "sem prefixo")]
    got = values([r[:2] for r in rows], "s string, t string", text.clean_title(C("s"), C("t")))
    assert got == [r[2] for r in rows]
    legacy = [("INFO: SES - x  y", "Outros", "SES - x  y"), (" csi  a ", "csi", "csi  a")]
    got = values([r[:2] for r in legacy], "s string, t string", text.clean_title_legacy(C("s"), C("t")))
    assert got == [r[2] for r in legacy]


def test_csi_gate(values):
    rows = [(" Aberto ", "CSI", "Aberto", "aberto"), (None, "CSI", "", "na"), ("x", "Outros", "na", "na")]
    data = [r[:2] for r in rows]
    assert values(data, "s string, t string", text.csi_status_gate(C("s"), C("t"))) == [r[2] for r in rows]
    assert values(data, "s string, t string", text.csi_status_gate_legacy(C("s"), C("t"))) == [r[3] for r in rows]


def test_dbms_and_environment(values):
    rows = [(" oracle ", "mysql", "ORACLE"), (None, "SqlServer down", "SQL SERVER"), ("", "mongo", "MONGODB"), (None, None, "")]
    got = values([r[:2] for r in rows], "f string, s string", text.detect_dbms(C("f"), C("s")))
    assert got == [r[2] for r in rows]
    names = {"prd": "Produção", "HOMOLOGAÇÃO": "Homologação", "desenv": "Desenvolvimento", "qa": "Teste",
             "outros": "Outro", "Lab": "Lab", None: ""}
    assert one(values, list(names), text.normalise_environment) == list(names.values())
    macros = {"Produção": "Produção", "Não Produção": "Produção", "Teste": "Não Produção", " ": None, None: None}
    assert one(values, list(macros), text.environment_macro) == list(macros.values())


def test_instance(values):
    rows = {"((a)b)": "(A", "x (ecp) (b)": "ECP", "sem": "", None: "", "()": ""}
    assert one(values, list(rows), text.extract_instance) == list(rows.values())


SERVERS = {
    "Server: SUMMARY Server: srv-77": "SRV-77",      # the second match of the first pattern wins
    "Host: bd01x Server: ab-99": "AB-99",            # pattern order beats text order
    "Server: a-1 Host: web-01": "WEB-01",            # too short, the next pattern is tried
    "INSTÂNCIA: orc_01": "ORC_01",
    "instancia - orc.02": "ORC.02",
    "ANALISE - coisa": "",                           # no digit, dot, dash or underscore
    "SRV-001 - crise": "SRV-001",
    "alerta - dbx_07 (ECP)": "DBX_07",
    "DB: prod1": "PROD1",
    "myServer: abc-12": "",                          # not a whole word
    "çServer: abc-12": "",                           # accented letters are word characters
    "ſerver: abc-12": "ABC-12",                      # the long s folds to s
    "SERVİDOR: abc-13": "ABC-13",
    None: "",
}


def test_server(values):
    assert one(values, list(SERVERS), text.extract_server) == list(SERVERS.values())
    assert one(values, list(SERVERS), lambda c: text.extract_server(c, stop_words=("DBX_07",))) == [
        "" if name == "DBX_07" else name for name in SERVERS.values()]


def test_logical_server(values):
    got = one(values, ["erro (ecp)", "Server: srv-77 (ecp)", "nada"], text.logical_server)
    assert [tuple(r) for r in got] == [("ECP", "ECP"), ("SRV-77", "ECP"), ("", "")]


def test_natural_key(values):
    rows = [(" host  a ", "i", "HOST A"), (" ", "inst", "INST"), (None, None, "")]
    got = values([r[:2] for r in rows], "h string, i string", text.server_natural_key(C("h"), C("i")))
    assert got == [r[2] for r in rows]
