"""Hand-written staging-shaped fixtures for unit tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

ACCOUNTS = ("account_id long, client_id long, agency_id long, employee_id long, account_type string, "
            "opening_date timestamp, total_balance decimal(18,2), available_balance decimal(18,2), "
            "last_posting_date timestamp")
CLIENTS = ("client_id long, client_full_name string, email string, client_type string, "
           "onboarding_date timestamp, cpf_cnpj string, birth_date date, address string, "
           "postal_code string")
TX = ("transaction_id long, account_id long, transaction_at timestamp, transaction_type string, "
      "transaction_amount decimal(18,2)")
PROPOSALS = ("proposal_id long, client_id long, employee_id long, proposal_date timestamp, "
             "monthly_interest_rate decimal(18,8), proposal_amount decimal(18,2), "
             "financing_amount decimal(18,2), down_payment decimal(18,2), "
             "installment_amount decimal(18,2), installment_count int, grace_period int, "
             "proposal_status string")
AGENCIES = ("agency_id long, agency_name string, address string, city string, state string, "
            "opening_date date, agency_type string")
BRIDGE = "employee_id long, agency_id long"

NEWEST = dt.datetime(2023, 6, 30, 12, 0, 0)


def D(x) -> Decimal:
    return Decimal(str(x))


def account(account_id, client_id, balance=1000, agency_id=1):
    return (account_id, client_id, agency_id, None, "PF", dt.datetime(2020, 1, 1), D(balance),
            None, None)


def client(client_id, name=None, onboarding=dt.datetime(2020, 1, 1)):
    return (client_id, name or f"Client {client_id}", None, "PF", onboarding, None, None, None, None)


def tx(tid, account_id, at, amount=10):
    return (tid, account_id, at, "PIX", D(amount))


def proposal(pid, client_id, status="Aprovada", employee_id=1, amount=100, rate="0.01",
             at=dt.datetime(2023, 1, 15)):
    return (pid, client_id, employee_id, at, D(rate), D(amount), None, None, None, None, None, status)


def recency_fixture(spark):
    """Accounts last active 0, 90, 91, 360, 361 days before the newest transaction, and one never."""
    offsets = [0, 90, 91, 360, 361]
    accounts = [account(i + 1, i + 1) for i in range(6)]
    clients = [client(i + 1) for i in range(6)]
    txs = [tx(100 + i, i + 1, NEWEST - dt.timedelta(days=d)) for i, d in enumerate(offsets)]
    return (spark.createDataFrame(accounts, ACCOUNTS), spark.createDataFrame(clients, CLIENTS),
            spark.createDataFrame(txs, TX), spark.createDataFrame([], PROPOSALS))
