"""The fixture views of ``tidemark.sources.fixture`` written as SQL common table expressions."""

from __future__ import annotations

from tidemark import schemas as S
from tidemark.sources.fixture import FIRST_UNKNOWN, FX_RATES, METHODS, PROVIDERS, UNKNOWN_OFFSET


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


COUNTRIES = _list(S.COUNTRY_CURRENCY)
CURRENCIES = _list(S.COUNTRY_CURRENCY.values())
CATEGORIES = _list(S.MERCHANT_CATEGORIES)
RATES = ", ".join(f"('{c}', cast({r} as decimal(18,6)))" for c, r in FX_RATES.items())

VIEWS = {
    "tx": f"""
      select event_id as transaction_id, ts as transaction_timestamp,
             epoch_us(ts) // 1000000 as t,
             cast(value as decimal(15,2)) as usd,
             case when event_type = 'error' then 'Declined' else 'Approved' end as status,
             {CURRENCIES}[k % 8 + 1] as currency,
             {COUNTRIES}[k % 8 + 1] as country,
             case when event_type in ('click','purchase','error')
                  then 'Online' else 'Local' end as channel,
             user_id, case when k < {FIRST_UNKNOWN} then k else k + {UNKNOWN_OFFSET} end as merchant_id, user_id * 4 + k % 4 as payment_id,
             user_id // 3 as device_id,
             case when event_type = 'error' and value < 10 then 1 else 0 end as is_fraudulent,
             case when event_type = 'error' and value < 10
                  then 'Card Probing' else 'No Fraud' end as fraud_type
      from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events)""",
    "m": f"""
      select p_partkey as merchant_id, p_name as merchant_name,
             {COUNTRIES}[p_partkey % 8 + 1] as country,
             case when p_size < 10 then 'Unknown' when p_size < 30 then 'Mid'
                  else 'Renowned' end as rating,
             {CATEGORIES}[p_partkey % 8 + 1] as category
      from part""",
    "pm": f"""
      select payment_id as payment_method_id, min(user_id) as user_id,
             {_list(METHODS)}[payment_id % 4 + 1] as payment_method,
             {_list(PROVIDERS)}[payment_id % 2 + 1] as provider,
             1 as active, min(transaction_timestamp) as created_at,
             min(t) as created
      from tx group by payment_id""",
    "usr": f"""
      select c_custkey as user_id, c_name as name,
             {COUNTRIES}[c_nationkey % 8 + 1] as country from customer""",
    "dev": """
      select device_id, min(user_id) as user_id, min(t) as first_used, max(t) as last_used
      from tx group by device_id""",
    "fx": f"select * from (values {RATES}) as r(currency, rate)",
    "txm": "select tx.*, m.category from tx left join m using (merchant_id)",
    "scored": """
      select event_id as transaction_id,
             case when event_type = 'error' and value < 10 then 1 else 0 end as label,
             cast(floor(value) as double) / 1000 as score
      from events""",
}

# Which views a view itself reads
_NEEDS = {"pm": ("tx",), "dev": ("tx",), "txm": ("tx", "m")}


def with_views(names: str, body: str) -> str:
    """``body`` preceded by the named views and the views those need."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    ctes = ",\n".join(f"{n} as ({VIEWS[n]})" for n in order)
    joiner = ",\n" if body.lstrip().startswith("+") else "\n"
    return f"with {ctes}{joiner}{body.lstrip().lstrip('+')}" if order else body
