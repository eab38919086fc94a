"""A tiny hand-made shop: raw text rows that hit the edge cases one by one."""

from __future__ import annotations

from starloom.schemas import RAW_COLUMNS, raw_schema

ROWS = {
    "customers": [
        ("c1", "u1", "01001", " sao paulo ", "SP"), ("c2", "u1", "01001", "sao paulo", "SP"), ("c3", "u1", "20000", "rio", "RJ"),
        ("c4", "u2", "30000", "b town", "BB"), ("c5", "u2", "40000", "a town", "AA"),
        ("c6", "u3", "50000", None, "CC"), ("c7", "u3", "60000", "z town", "ZZ"),
        ("c8", "  ", "70000", "nowhere", "NN"), ("c9", None, "70000", "nowhere", "NN"),
    ],
    "orders": [
        ("o1", "c1", "delivered", "2017-01-10 10:00:00", "2017-01-10 09:00:00", "2017-01-11 10:00:00", "2017-01-15 00:00:00", "2017-01-15 00:00:00"),
        ("o2", "c2", "delivered", "2017-01-10 10:00:00", "2017-01-10 10:00:00", "2017-01-12 10:00:00", "2017-01-15 08:00:00", "2017-01-15 00:00:00"),
        ("o3", "c4", "shipped", "2017-02-01 00:00:00", "2017-02-01 00:20:00", "2017-02-03 00:00:00", "", "2017-02-20 00:00:00"),
        ("o4", "c6", "canceled", "2021-02-01 00:00:00", "", "", "", "2021-03-01 00:00:00"),
        ("o5", "c8", None, "2017-03-01 00:00:00", "", "", "", ""),
        ("o6", "missing", "strange", "2017-03-05 00:00:00", "", "", "", ""),
        (None, "c7", "created", "2017-03-06 00:00:00", "", "", "", ""),
        ("  ", "c7", "created", "2017-03-06 00:00:00", "", "", "", ""),
    ],
    "order_items": [
        ("o1", "1", "p1", "s1", "", "12.345", "1.00"), ("o1", "2", "p2", "s1", "", "", "2.50"), ("o2", "1", "p1", "s2", "", "10.00", ""),
        ("o3", "1", "p3", "s1", "", "", ""), ("o4", "1", "unknown", "unknown", "", "5.00", "1.00"), ("lost", "1", "p1", "s1", "", "7.00", "0.00"),
        ("o5", " ", "p1", "s1", "", "9.00", "9.00"), (None, "1", "p1", "s1", "", "9.00", "9.00"),
    ],
    "order_payments": [
        ("o1", "1", "card", "1", "10.00"), ("o1", "2", "voucher", "1", "5.85"), ("o1", "3", "voucher", "1", ""), ("o2", "1", "card", "1", "8.00"), ("o3", "1", "card", "1", ""),
    ],
    "order_reviews": [
        ("r1", "o1", "3", None, None, "2017-02-01 00:00:00", "2017-02-02 00:00:00"), ("r2", "o1", "5", None, 'fine, "really"\nfine', "2017-03-01 00:00:00", "2017-03-02 00:00:00"),
        ("r3", "o2", "4", None, None, "2017-02-01 00:00:00", "2017-02-02 00:00:00"), ("r4", "o2", "2", None, None, "2017-02-01 00:00:00", "2017-02-03 00:00:00"),
        ("r5", "o3", "1", None, None, None, "2017-01-01 00:00:00"), ("r6", "o3", "5", None, None, "2018-01-01 00:00:00", "2018-01-01 00:00:00"),
        ("r7", "o3", " ", None, None, "2019-01-01 00:00:00", "2019-01-01 00:00:00"),
    ],
    "products": [
        ("p1", "perfumaria", "10", "100", "1", "0.005", "1", "2", "3"), ("p2", "sem_nome", "10", "", "2", "500", "1", "2", "3"),
        ("p3", None, "", "", "", "", "", "", ""), (" ", "perfumaria", "", "", "", "", "", "", ""),
    ],
    "sellers": [("s1", "01001", "santa barbara d'oeste", "SP"), ("s2", "20000", " embu-guacu", "RJ"), ("", "1", "x", "y")],
    "geolocation": [],
    "product_category_name_translation": [("perfumaria", "perfumery")],
}


def raw_shop(spark):
    assert set(ROWS) == set(RAW_COLUMNS)
    return {t: spark.createDataFrame(rows, raw_schema(t)) for t, rows in ROWS.items()}


def by(df, *keys):
    """Rows as a dict keyed by the given columns."""
    out = {}
    for r in df.collect():
        key = tuple(r[k] for k in keys)
        out[key[0] if len(keys) == 1 else key] = r
    return out
