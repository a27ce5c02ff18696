"""Small landed payloads of the market data sets, written as API responses."""

from __future__ import annotations

import json
from pathlib import Path


def listing(key, rank, price, quoted=True, **fields):
    record = {
        "id": key, "name": f"Coin {key}", "symbol": f"C{key}", "slug": f"coin-{key}", "tags": ["a", "b"],
        "platform": {"id": 1, "name": "P"}, "infinite_supply": False, "circulating_supply": 50.5, "total_supply": 80,
        "max_supply": 100, "date_added": "2024-04-20T00:00:00.000Z", "num_market_pairs": 7, "cmc_rank": rank,
        "last_updated": "2024-05-01T05:00:00.000Z", "tvl_ratio": None, "self_reported_circulating_supply": None,
        "self_reported_market_cap": None, "minted_market_cap": 999.25,
    }
    if quoted:
        record["quote"] = {
            "USD": {
                "price": price, "volume_24h": price * 10, "volume_change_24h": 1.5, "cex_volume_24h": price * 6,
                "dex_volume_24h": price * 2, "percent_change_1h": 0.1, "percent_change_24h": 0.5 * rank,
                "percent_change_7d": 1.0, "percent_change_30d": -2.0, "percent_change_60d": 3.0,
                "percent_change_90d": 4.0, "market_cap": price * 1000, "market_cap_dominance": price / 10,
                "fully_diluted_market_cap": price * 2000, "tvl": None if key == 2 else price * 100,
                "last_updated": "2024-05-01T05:30:00.000Z",
            }
        }
    record.update(fields)
    return record


def category(key, coins, cap=1000.0):
    return {
        "id": key, "name": f"Sector {key}", "title": f"Title {key}", "description": 'multi\nline, "quoted"',
        "num_tokens": len(coins), "avg_price_change": 0.5, "market_cap": cap, "market_cap_change": None,
        "volume": 5.5, "volume_change": 0.1, "last_updated": "2024-05-01T04:00:00.000Z",
        "coins": [{"id": c, "name": f"Coin {c}", "quote": {"USD": {"price": 1.0}}} for c in coins],
    }


def mapped(key, **fields):
    return {
        "id": key, "rank": key, "name": f"Coin {key}", "symbol": f"C{key}", "slug": f"coin-{key}", "is_active": 1,
        "first_historical_data": "2013-04-28T18:47:21.000Z", "last_historical_data": "2024-05-01T00:00:00.000Z",
        "platform": None, **fields,
    }


def info(key):
    return {
        "id": key, "category": "coin", "description": f"About {key}", "logo": f"logo/{key}.png",
        "urls": {"website": ["x"]}, "tags": None, "date_launched": "2010-01-03T00:00:00.000Z",
    }


def land(folder, name: str, data) -> None:
    path = Path(folder) / name
    path.mkdir(parents=True, exist_ok=True)
    payload = {"status": {"error_code": 0}, "data": data}
    (path / "payload.json").write_text(json.dumps(payload, indent=4), encoding="utf-8")
