"""Literal record-by-record consolidation, the brute-force twin of the ledger fold."""


def applies(rule, m):
    if not rule.get("activo") or m["tipo"] not in rule["tipos_origen"] or m["bloque"] != rule["bloque_origen"]:
        return False
    for key, field, wanted in (
        ("excluir_conceptos", "concepto", False), ("incluir_conceptos", "concepto", True),
        ("excluir_dominio", "dominio", False), ("incluir_dominio", "dominio", True),
    ):
        if key in rule and (m[field] in rule[key]) != wanted:
            return False
    if "incluir_origen" in rule and not {m["origen"], m["cuenta_destino"]} & set(rule["incluir_origen"]):
        return False
    sign = rule["condicion_valor"]
    if (sign == "POSITIVO" and m["valor"] <= 0) or (sign == "NEGATIVO" and m["valor"] >= 0):
        return False
    return not (rule.get("requiere_origen") and not m["origen"])


def account_type(config, domain, name):
    for kind, names in config.catalogue.get(domain, {}).get("CAJA_ACTUAL", {}).items():
        if name in names:
            return kind
    return None


def walk(movements, config, book=None):
    """{key: [valor, bloque, origen]} after applying the movements one by one in order."""
    book = {k: list(v) for k, v in (book or {}).items()}

    def key(domain, corte, kind, concept, origin):
        return (domain, corte, kind, concept, origin if kind in ("CUENTA", "TARJETA") and origin else None)

    def add(k, amount, block, origin):
        entry = book.setdefault(k, [0, None, None])
        entry[0] += amount
        entry[1], entry[2] = block, origin

    for m in movements:
        matched = False
        for rule in config.rules:
            if not applies(rule, m):
                continue
            matched = matched or rule.get("tipo") != "COMPLEMENTARIA"
            for a in rule["acciones"]:
                amount = {"DECREMENTAR": -abs(m["valor"]), "REPLICAR": m["valor"]}.get(a["operacion"], abs(m["valor"]))
                origin = m["origen"]
                if a.get("origen_destino") == "USAR_CUENTA_DESTINO":
                    origin = m["cuenta_destino"]
                    if not origin:
                        continue
                    if account_type(config, m["dominio"], origin) == "TARJETA" and a["operacion"] == "INCREMENTAR":
                        amount = -amount
                elif a.get("origen_destino") == "USAR_CUENTA_AFECTADA":
                    listed = rule.get("incluir_origen", [])
                    origin = next((x for x in (m["origen"], m["cuenta_destino"]) if x and x in listed), None)
                    if origin is None:
                        continue
                k = key(a.get("dominio_destino") or m["dominio"], m["corte"], a["tipo_destino"], a.get("concepto_destino") or m["concepto"], origin)
                if a["bloque_destino"] == "PROYECCION" and amount < 0:
                    if k not in book:
                        amount = 0
                    elif book[k][0] + amount < 0:
                        amount = -book[k][0]
                if amount != 0:
                    add(k, amount, a["bloque_destino"], origin)
        if not matched:
            own = m["origen"] if m["tipo"] in ("CUENTA", "TARJETA") else None
            add(key(m["dominio"], m["corte"], m["tipo"], m["concepto"], m["origen"]), m["valor"], m["bloque"], own)
    return book
