"""Lead distribution: seeded shuffles, round-robin and block assignment to
consultants, quota sampling per campaign (O4-O8, W7-W10, A24, C20-C21).

The reference shuffles with NumPy's seeded generator; we order by
``md5(seed || id)`` — the same uniformity, deterministic and restatable in
SQL.  No ranking runs in a single task:

* uncapped ranks use ``global_rank`` over the ranges that the first three hex
  digits of the md5 key name (4,096 tasks at most), so the distributed rank
  equals the exact global md5 order; consultants are ranked the same way, over
  ranges of their id;
* capped samples use two-phase top-k per key (exact).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions import dates as D
from ledgerlens.operators.leads import FORBIDDEN_CHANNELS, RECOMMENDED_CHANNELS
from ledgerlens.operators.skew import global_rank, top_k_per_key

SEED = 42
PER_CONSULTANT = 500
CAMPAIGN_LIMIT = 1000
EXTRA_SHARE = 0.05     # of the capacity, drawn from beyond it
CRM_PER_CONSULTANT = 100
NAME_MATCH = 80        # similarity below which a lead is for the general CRM


def shuffle_key(id_col: str = "id", seed: int = SEED) -> Column:
    """Deterministic shuffle key ``md5(seed || id)``."""
    return F.md5(F.concat(F.lit(str(seed)), F.col(id_col).cast("string")))


def _md5_prefix_salt(key: str) -> Column:
    return F.conv(F.substring(F.col(key), 1, 3), 16, 10).cast("int")


def ranked_consultants(cons: DataFrame) -> DataFrame:
    """Consultants numbered 0..n-1 by id."""
    ranked = global_rank(cons.select("usuario_id", F.col("nome").alias("consultor")), "usuario_id", out="_idx")
    return ranked.withColumn("_idx", F.col("_idx") - 1)


def distribution_candidates(classified: DataFrame, as_of, priority: int = 3) -> DataFrame:
    """C20 filter: allowed channels (NULL excluded), arrived between
    ``as_of - 2 business days`` and ``as_of`` (dates), given priority."""
    day = F.to_date("data_chegada")
    start = D.minus_business_days(F.to_date(D.ts_ntz(as_of)), 2)
    return classified.filter(~F.col("canal").isin(*FORBIDDEN_CHANNELS) & F.col("canal").isNotNull()
                             & (day >= start) & (day <= F.to_date(D.ts_ntz(as_of)))
                             & (F.col("prioridade") == priority))


def round_robin(cands: DataFrame, cons: DataFrame) -> DataFrame:
    """Rank by the shuffle key, consultant = (rank - 1) mod n."""
    ranked = global_rank(cands.withColumn("_k", shuffle_key()), "_k", salt=_md5_prefix_salt("_k"))
    rc = ranked_consultants(cons)
    n = rc.agg(F.count(F.lit(1))).scalar()
    out = ranked.withColumn("_idx", F.pmod(F.col("rn") - 1, n))
    return out.join(rc, "_idx").drop("_idx", "_k")


def block_assignment(cands: DataFrame, cons: DataFrame, per_consultant: int = PER_CONSULTANT) -> DataFrame:
    """Rank by the shuffle key, blocks of ``per_consultant`` rows per
    consultant, up to the total capacity."""
    ranked = global_rank(cands.withColumn("_k", shuffle_key()), "_k", salt=_md5_prefix_salt("_k"))
    rc = ranked_consultants(cons)
    out = ranked.withColumn("_idx", F.floor((F.col("rn") - 1) / per_consultant).cast("long"))
    return out.join(rc, "_idx").drop("_idx", "_k")


def campaign_occupancy(assigned: DataFrame, key: str = "campanha_id") -> DataFrame:
    """Current rows per campaign."""
    return assigned.groupBy(key).agg(F.count(F.lit(1)).cast("long").alias("ocupacao"))


def quota_sample(cands: DataFrame, occupancy: DataFrame, priorities=(1, 2), limit: int = CAMPAIGN_LIMIT) -> DataFrame:
    """O5 + O8: per campaign (one per priority, disjoint), the first
    ``limit - occupancy`` candidates by shuffle key; one ranked pass.

    Two-phase top-k (exact): no campaign is ranked whole in one task."""
    c = (cands.filter(F.col("canal").isin(*RECOMMENDED_CHANNELS) & F.col("prioridade").isin(*priorities))
         .withColumn("campanha_id", F.col("prioridade").cast("long"))
         .withColumn("_k", shuffle_key()))
    top = top_k_per_key(c, ["campanha_id"], [F.col("_k").asc(), F.col("id").asc()], limit, "id")
    room = occupancy.select("campanha_id", (F.lit(limit) - F.col("ocupacao")).alias("_room"))
    j = top.join(room, "campanha_id", "left")
    return j.filter(F.col("rn") <= F.coalesce(F.col("_room"), F.lit(limit))).drop("_room", "_k")


def distribute(cands: DataFrame, cons: DataFrame, per_consultant: int = PER_CONSULTANT, order_col: str = "id") -> DataFrame:
    """C20: all candidates, dealt in turn in their order, while they fit the
    capacity; beyond it (W8), the first ``capacity`` of them mixed with an
    exact draw of 5 % of the capacity from the rest, cut to the capacity again
    and dealt in blocks of ``per_consultant``.

    Order, draw and mix are three distributed ranks; no row passes the driver."""
    rc = ranked_consultants(cons)
    people, waiting = cons.count(), cands.count()
    capacity = people * per_consultant
    ordered = global_rank(cands, order_col, out="_pos")
    if waiting <= capacity:
        dealt = ordered.withColumn("rn", F.col("_pos")).withColumn("_idx", F.pmod(F.col("_pos") - 1, F.lit(max(1, people))))
        return dealt.join(rc, "_idx").drop("_idx", "_pos")
    extra = min(max(1, int(capacity * EXTRA_SHARE)), waiting - capacity)
    best = ordered.filter(F.col("_pos") <= capacity).drop("_pos")
    rest = ordered.filter(F.col("_pos") > capacity).withColumn("_k", shuffle_key())
    drawn = global_rank(rest, "_k", salt=_md5_prefix_salt("_k"), out="_pos").filter(F.col("_pos") <= extra).drop("_pos", "_k")
    mixed = best.unionByName(drawn).withColumn("_k", F.md5(F.concat(F.lit(f"{SEED}-"), F.col("id").cast("string"))))
    ranked = global_rank(mixed, "_k", salt=_md5_prefix_salt("_k")).filter(F.col("rn") <= capacity)
    return ranked.withColumn("_idx", F.floor((F.col("rn") - 1) / per_consultant).cast("long")).join(rc, "_idx").drop("_idx", "_k")


def _ranked_sample(df: DataFrame, n: int | None) -> DataFrame:
    ranked = global_rank(df.withColumn("_k", shuffle_key()), "_k", salt=_md5_prefix_salt("_k")).drop("_k")
    return ranked if n is None else ranked.filter(F.col("rn") <= n)


def crm_general(enriched: DataFrame, cons: DataFrame) -> DataFrame:
    """C21 (general): priority 1 in a recommended channel, ruler not tested,
    names alike below ``NAME_MATCH``: a sample of 100 a consultant."""
    rows = enriched.filter(F.col("canal").isin(*RECOMMENDED_CHANNELS) & (F.col("abriu_regua") == "NAO TESTADO")
                           & (F.col("prioridade") == 1) & (F.col("semelhanca_nomes") < NAME_MATCH))
    return _ranked_sample(rows, CRM_PER_CONSULTANT * cons.count())


def crm_open_ruler(enriched: DataFrame) -> DataFrame:
    """C21 (opened ruler) + O2: priority 1 in a recommended channel whose ruler
    opened, all of them, shuffled."""
    return _ranked_sample(enriched.filter(F.col("canal").isin(*RECOMMENDED_CHANNELS) & (F.col("abriu_regua") == "SIM")
                                          & (F.col("prioridade") == 1)), None)


@dataclass(frozen=True)
class Campaign:
    """A campaign that takes leads in its turn."""
    key: str
    campaign_id: int
    priority: int
    lead_type: str | None = None
    limit: int = CAMPAIGN_LIMIT      # members it may have in all
    most: int | None = None          # leads it may take in one run
    first_in_3_months: bool = False  # only leads with qtd_3_meses = 1


def campaign_cascade(enriched: DataFrame, occupancy: DataFrame, campaigns: list[Campaign]) -> DataFrame:
    """C21 + O5 + O8: every campaign in turn draws its room (limit less current
    members, A24) from the leads that none before it has taken.

    All draws follow one shuffle key, so a campaign's draw is the key of its
    last lead: found by a distributed top-k of at most ``limit`` keys over the
    rows that earlier cuts leave, and then a plain condition on each row.  No
    chosen row is collected or joined back."""
    taken = {r["campanha_id"]: r["ocupacao"] for r in
             occupancy.filter(F.col("campanha_id").isin([c.campaign_id for c in campaigns])).collect()}  # a row a campaign
    rows = enriched.filter(F.col("canal").isin(*RECOMMENDED_CHANNELS)).withColumn("_k", F.struct(shuffle_key().alias("k"), F.col("id").alias("id")))
    chosen = F.lit(None).cast("string")
    for c in campaigns:
        room = max(0, c.limit - taken.get(c.campaign_id, 0))
        room = room if c.most is None else min(room, c.most)
        wanted = F.col("prioridade") == c.priority
        if c.lead_type is not None:
            wanted = wanted & (F.col("tipo_lead") == c.lead_type)
        if c.first_in_3_months:
            wanted = wanted & (F.col("qtd_3_meses") == 1)
        cut = rows.filter(wanted & chosen.isNull()).select("_k").orderBy("_k").limit(room).agg(F.max("_k").alias("cut")).first().cut if room else None
        if cut is not None:
            within = F.col("_k") <= F.struct(F.lit(cut.k).alias("k"), F.lit(cut.id).alias("id"))
            chosen = F.when(chosen.isNotNull(), chosen).when(wanted & within, F.lit(c.key))
    out = rows.withColumn("chave", chosen).filter(F.col("chave").isNotNull())
    # a campaign's draw is at most ``limit`` rows
    return out.withColumn("rn", F.row_number().over(Window.partitionBy("chave").orderBy("_k")).cast("long")).drop("_k")
