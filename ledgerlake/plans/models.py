"""The model graph: raw -> staging -> marts, wired lazily.

``Models`` resolves each model on first use from the raw tables, so a query
that needs two staging views only builds (and scans) those two. Marts that
feed other marts are passed as DataFrames; when the pipeline materializes a
mart, it swaps the written table in so downstream models read it instead of
recomputing it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators import staging as stg
from ledgerlake.operators.activity import account_activity, transactions_by_account
from ledgerlake.operators.credit import agency_performance, credit_funnel, credit_kpis
from ledgerlake.operators.cross_sell import cross_sell
from ledgerlake.operators.drivers import driver_ranking
from ledgerlake.operators.distribution import transaction_statistics
from ledgerlake.operators.engagement import client_engagement, commercial_kpis
from ledgerlake.operators.fees import agency_fee_revenue, client_fee_revenue, fee_table
from ledgerlake.operators.gaps import account_alerts, transaction_gaps
from ledgerlake.operators.quality import quality_dashboard
from ledgerlake.operators.volume import daily_volume

#: Raw table of transaction fees; without one the reference's fees hold.
FEE_TABLE = "tarifas_transacao"

# Staging model -> (raw table, builder).
STAGING: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "stg_agencies": ("agencias", stg.stg_agencies),
    "stg_clients": ("clientes", stg.stg_clients),
    "stg_employees": ("colaboradores", stg.stg_employees),
    "stg_employee_agency": ("colaborador_agencia", stg.stg_employee_agency),
    "stg_accounts": ("contas", stg.stg_accounts),
    "stg_proposals": ("propostas_credito", stg.stg_proposals),
    "stg_transactions": ("transacoes", stg.stg_transactions),
}

# Shared intermediate -> (builder, upstream models): the pipeline writes it once, unlisted.
SHARED: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "transactions_by_account": (transactions_by_account, ("stg_transactions",)),
}

# Mart -> (builder, upstream models in argument order).
MARTS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "account_activity": (account_activity, ("stg_accounts", "transactions_by_account")),
    "credit_funnel": (credit_funnel, ("stg_proposals",)),
    "agency_performance": (agency_performance,
                           ("stg_agencies", "stg_employee_agency", "stg_proposals")),
    "daily_volume": (daily_volume, ("stg_transactions",)),
    "client_engagement": (client_engagement,
                          ("stg_clients", "stg_accounts", "transactions_by_account",
                           "stg_proposals")),
    "commercial_kpis": (commercial_kpis, ("client_engagement",)),
    "credit_kpis": (credit_kpis, ("credit_funnel",)),
    "cross_sell": (cross_sell, ("stg_accounts", "stg_clients", "stg_proposals")),
    "driver_ranking": (driver_ranking, ("client_engagement",)),
    "quality_dashboard": (quality_dashboard,
                          ("stg_clients", "stg_agencies", "stg_accounts", "stg_proposals")),
}

# Planned marts, written only where a run names them -> (builder, upstream models).
EXTENSIONS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "transaction_gaps": (transaction_gaps, ("stg_transactions",)),
    "account_alerts": (account_alerts, ("transaction_gaps",)),
    "transaction_statistics": (transaction_statistics, ("stg_transactions",)),
    "client_fee_revenue": (client_fee_revenue, ("stg_transactions", "stg_accounts", FEE_TABLE)),
    "agency_fee_revenue": (agency_fee_revenue, ("stg_transactions", "stg_accounts", FEE_TABLE)),
}


class Models:
    """Lazily resolved model graph over a mapping of raw tables."""

    def __init__(self, raw: Mapping[str, DataFrame] | object):
        self.raw = raw
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def replace(self, name: str, df: DataFrame) -> None:
        """Use ``df`` (e.g. the written table) for ``name`` from now on."""
        self._built[name] = df

    def _build(self, name: str) -> DataFrame:
        if name in STAGING:
            raw_name, builder = STAGING[name]
            return builder(self.raw[raw_name])
        for group in (MARTS, SHARED, EXTENSIONS):
            if name in group:
                builder, deps = group[name]
                return builder(*(self[d] for d in deps))
        if name == FEE_TABLE:
            try:
                return self.raw[FEE_TABLE]
            except KeyError:
                return fee_table(SparkSession.active())
        raise KeyError(f"unknown model {name!r}")


def build_levels() -> list[list[str]]:
    """Marts grouped so that each level only reads staging and earlier levels."""
    done = {*STAGING, *SHARED}
    pending = list(MARTS)
    levels: list[list[str]] = []
    while pending:
        level = [m for m in pending if all(d in done for d in MARTS[m][1])]
        if not level:
            raise ValueError(f"cycle among {pending}")
        levels.append(level)
        done.update(level)
        pending = [m for m in pending if m not in level]
    return levels


def build_order() -> list[str]:
    """Staging views first, then marts with every mart after the marts it reads."""
    done: list[str] = list(STAGING)
    pending = list(MARTS)
    while pending:
        for name in pending:
            if all(d in done or d in SHARED for d in MARTS[name][1]):
                done.append(name)
                pending.remove(name)
                break
        else:
            raise ValueError(f"cycle among {pending}")
    return done

