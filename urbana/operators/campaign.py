"""Audiences, dispatch and retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbana.functions.text import brl, short_name, social_or_legal
from urbana.operators import nested
from urbana.operators.joins import suppress
from urbana.operators.select import escalating_groups, first_by, latest_by, seeded_order
from urbana.operators.sets import union_distinct


def prepare_dispatch(df: DataFrame, person: str, phone: str, order: list[str], failed: DataFrame, sent: DataFrame) -> DataFrame:
    """One row of each person, without failed phones and phones already sent to, then one row of each phone."""
    people = first_by(df.where(F.col(phone).isNotNull() & (F.trim(phone) != "")), [person], order)
    return first_by(suppress(suppress(people, failed, [phone]), sent, [phone]), [phone], order)


def retry_round(base: DataFrame, failed: DataFrame, key: str, others: str, phone: str, attempt: int) -> DataFrame:
    """Attempt ``i`` of failed people goes to their ``i``-th other phone; people without one drop out."""
    again = base.join(failed.select(key), key, "left_semi").withColumn(phone, F.get(others, F.lit(attempt - 1)))
    return again.where(F.col(phone).isNotNull())


def failed_phones(sends: DataFrame, phone: str, ts: str, failed: Column, quarantined: DataFrame, ties: list[str] = ()) -> DataFrame:
    """Phones whose last send failed, and quarantined ones, each once."""
    return union_distinct(latest_by(sends, [phone], ts, list(ties)).where(failed).select(phone), quarantined.select(phone))


def reachable(df: DataFrame, phones: DataFrame, phone: str, consents: str, quality: str) -> DataFrame:
    """Rows whose phone is not of bad quality and under no quarantine; unknown phones are reachable."""
    bad = phones.where((F.col(quality) == "RUIM") | F.exists(consents, lambda x: x["indicador_quarentena"]))
    return df.join(bad.select(phone), phone, "left_anti")


def campaign_succeeded(status: DataFrame, campaign: Column, since: Column, delivered: Column) -> DataFrame:
    """Sends and deliveries of a campaign since a time, and whether any was delivered."""
    return status.where(campaign & since).agg(F.count(F.lit(1)).alias("envios"), F.count_if(delivered).alias("entregas")).withColumn("sucesso", F.col("entregas") > 0)


def throttle(log: DataFrame, hash_col: str, ts: str, message_hash: str, now, cap: int, gap_minutes: int) -> DataFrame:
    """One row: whether a message may be sent now, given today's log, and why not."""
    today = log.where(F.to_date(ts) == F.to_date(F.lit(now)))
    seen = today.agg(F.count_if(F.col(hash_col) == message_hash).alias("iguais"), F.count(F.lit(1)).alias("hoje"), F.max(ts).alias("ultimo"))
    minutes = F.timestamp_diff("MINUTE", F.col("ultimo"), F.lit(now))
    why = F.when(F.col("iguais") > 0, "duplicate").when(F.col("hoje") >= cap, "cap").when(minutes < gap_minutes, "gap").otherwise("send")
    return seen.withColumn("decisao", why)


def pending(history: DataFrame, sent: DataFrame, key: str, eligible: Column) -> DataFrame:
    """One row: rows not sent yet, and how many of them are eligible."""
    return suppress(history, sent, [key]).agg(F.count(F.lit(1)).alias("total"), F.count_if(eligible).alias("elegiveis"))


def cascade(df: DataFrame, key: str, lookups: list[tuple[str, DataFrame]], value: str) -> DataFrame:
    """``df`` with a value and its source: each lookup fills only the rows that the ones before left empty.

    A lookup counts once for each key, with the smallest of its values that are not null, so no row of ``df`` ever becomes two.
    """
    out = df.withColumn(value, F.lit(None).cast("string")).withColumn("fonte", F.lit(None).cast("string"))
    for name, lookup in lookups:
        got = lookup.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(F.col(key).alias("__k")).agg(F.min(value).alias("__v"))
        out = out.join(got, (F.col(key) == F.col("__k")) & F.col(value).isNull(), "left")
        hit = F.col(value).isNull() & F.col("__v").isNotNull()
        out = out.withColumn("fonte", F.when(hit, name).otherwise(F.col("fonte"))).withColumn(value, F.coalesce(value, "__v")).drop("__k", "__v")
    return out


def consenting(phone: Column) -> Column:
    """Whether the main phone of ``telefone`` has neither opted out nor is under quarantine; unknown is no."""
    main = phone["principal"]
    return F.coalesce(~main["indicador_optout"] & ~main["indicador_quarentena"], F.lit(False))


def charged(sends: DataFrame, legacy: DataFrame, charge: str, reminder: str) -> DataFrame:
    """``(cpf, telefone, data_cobranca, data_lembrete)``: the last charge and the last reminder that reached each person and phone.

    ``sends(cpf, telefone, modelo, data, indicador_quarentena)`` and ``legacy(cpf, telefone, modelo, data, data_falha)`` are two histories of one kind.
    """
    good = sends.where(~F.col("indicador_quarentena")).select("cpf", "telefone", "modelo", "data")
    every = good.unionByName(legacy.where("data_falha IS NULL").select("cpf", "telefone", "modelo", "data")).where(F.col("modelo").isin(charge, reminder))
    return every.groupBy("cpf", "telefone").agg(*[F.max(F.when(F.col("modelo") == m, F.col("data"))).alias(n) for m, n in ((charge, "data_cobranca"), (reminder, "data_lembrete"))])


def due_reminders(debtors: DataFrame, reached: DataFrame, people: DataFrame, today, days: int, excluded: str, closed: list[str]) -> DataFrame:
    """Reminders of instalments that fall due in ``days``: one row for each person and phone reached by a charge.

    ``debtors(cpf, guias, cdas)`` holds slips ``guias`` of ``(id, criacao, cotas)``, instalments ``cotas`` of ``(vencimento, valor, paga, observacoes, barras, pix)`` and
    certificates ``cdas`` of ``(id, situacao)``, nested. Of a person's open instalments on slips made since the charge, the one of the newest slip that falls due first
    counts, if any certificate is not ``closed``; it makes a reminder only if it is the one that falls due then. ``people(cpf, nome_social, nome, telefone_rmi)``
    must consent. Slips and certificates of a person are not tied to each other, so they are never multiplied.
    """
    at = reached.join(debtors, "cpf")
    slips = nested.where(F.col("guias"), lambda g: g["criacao"].isNull() | (g["criacao"] >= F.col("data_cobranca")))
    fields = ("vencimento", "valor", "paga", "observacoes", "barras", "pix")
    quotas = nested.inner(slips, "cotas", lambda g, c: F.struct(g["id"].alias("guia"), g["criacao"].alias("criacao"), *[c[f].alias(f) for f in fields]))
    open_ = nested.where(quotas, lambda c: ~c["paga"] & (c["observacoes"] != excluded) & c["barras"].isNotNull() & c["pix"].isNotNull())
    at = at.where(nested.any_of(F.col("cdas"), lambda x: ~x["situacao"].isin(closed))).withColumn("cota", nested.first(open_, lambda c: nested.latest(c["criacao"]), lambda c: c["vencimento"]))
    due = at.where(F.col("cota.vencimento") == F.date_add(F.lit(today), days)).drop("guias", "cdas")
    named = due.join(people.where(consenting(F.col("telefone_rmi"))), "cpf")
    return named.select(
        "telefone", F.col("cpf").alias("SubscriberKey"), short_name(social_or_legal(F.col("nome_social"), F.col("nome"))).alias("nome_sobrenome"),
        F.col("cota.vencimento").alias("data_vencimento"), F.col("cota.guia").alias("numero_guia"), brl(F.col("cota.valor")).alias("valor_guia"), F.col("cota.barras").alias("cod_boleto"), F.col("cota.pix").alias("cod_pix"),
    ).distinct()


def debt_charges(debtors: DataFrame, people: DataFrame, sent: DataFrame, today, active: list[str], most: float, oldest: int, months: int, seed: str, limit: int) -> DataFrame:
    """The first ``limit`` people to charge, in a seeded order, with their experiment group.

    ``debtors(cpf, cdas, vencidas)`` holds certificates ``cdas`` of ``(id, geracao, situacao, saldo)``; those of an ``active`` situation count, each once. A person is charged who owes
    at most ``most`` in all, has overdue instalments or unknown ones (``vencidas``), is at most ``oldest`` calendar years old, and has a certificate of the last ``months``.
    ``people(cpf, nome, nascimento, telefone, estrategia)`` may be sent to (``estrategia`` ENVIAR, TESTAR or EVITAR) and is in ``sent(cpf)`` no more.
    """
    ways = people.where(F.col("estrategia").isin("ENVIAR", "TESTAR", "EVITAR") & F.col("telefone").isNotNull() & F.col("nascimento").isNotNull())
    certificates = nested.distinct(nested.where(F.col("cdas"), lambda c: c["situacao"].isin(active)), "id", "geracao", "saldo")
    owing = debtors.where(F.coalesce(F.col("vencidas") > 0, F.lit(True))).select("cpf", certificates.alias("c")).where(F.size("c") > 0)
    sums = owing.select(
        "cpf", F.size("c").cast("long").alias("n_cdas_ativas"), nested.total(F.col("c"), lambda x: x["saldo"], "decimal(18,2)").cast("double").alias("soma_divida_total"),
        F.array_max(F.transform("c", lambda x: x["geracao"])).alias("dt_ultima_cda"),
    )
    age = (F.year(F.lit(today)) - F.year("nascimento")).cast("int")
    found = suppress(ways, sent, ["cpf"]).withColumn("idade", age).where(F.col("idade") <= oldest).join(sums, "cpf")
    found = found.where((F.col("soma_divida_total") <= most) & (F.col("dt_ultima_cda") >= F.add_months(F.lit(today), -months)))
    placed = escalating_groups(seeded_order(found, "cpf", seed, "ordem_sorteio"), "ordem_sorteio")
    return placed.select("cpf", "telefone", short_name(F.col("nome")).alias("nome_sobrenome"), "idade", "n_cdas_ativas", "soma_divida_total", "dt_ultima_cda", "ordem_sorteio", F.col("grupo").alias("grupo_escalonado"), F.col("alvo").alias("tamanho_alvo_grupo")).orderBy("ordem_sorteio").limit(limit)
