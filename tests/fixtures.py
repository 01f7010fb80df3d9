"""Small CSV files in the shape of the retail sources, made of edge cases: the
NULL marker, quoted commas and quotes, kept blanks, an empty text, unknown
keys, a sale without a date."""

import os

#: Header lines; the blank before the last name of sales is part of the format.
HEADERS = {
    "customers": "customer_id,name,address,created_at,updated_at",
    "products": "product_id,name,category,price,created_at,updated_at",
    "stores": "store_id,name,location,created_at,updated_at",
    "sales": "sale_id,customer_id,product_id,store_id,sale_date,quantity,total_amount,created_at, updated_at",
}
MADE, CHANGED = "2024-03-04 08:15:00", "2024-03-05 09:30:00"
ROWS = {
    "customers": [
        ["41", "Nora Lind", '"Quay 4, Upper Town"', MADE, CHANGED],
        ["42", "Omar Said", "\\N", MADE, MADE],
        ["47", '"Pia ""P"" Voss"', '"  back yard  "', MADE, MADE],
        ["60", "Quin Abara", "Mill Road", MADE, MADE],
    ],
    "products": [
        ["900", "Rope 10 m", "Sailing", "1250.25", MADE, MADE],
        ["901", "Compass", "\\N", "7.5", MADE, MADE],
        ["905", '"Anchor, folding"', "Sailing", "48", MADE, MADE],
    ],
    "stores": [
        ["3", "Dock", "Harbour", MADE, MADE],
        ["5", "Fair", "", MADE, MADE],
    ],
    "sales": [
        ["7001", "41", "900", "3", "2024-03-10 12:00:00", "2", "2500.50", MADE, MADE],
        ["7002", "42", "901", "5", "2024-03-10 17:45:00", "1", "7.50", MADE, MADE],
        ["7005", "47", "905", "3", "2024-03-12 09:05:00", "3", "144.00", MADE, MADE],
        ["7009", "60", "900", "88", "2024-03-12 10:00:00", "1", "1250.25", MADE, MADE],  # unknown store
    ],
}


def text(table: str, rows: list[list[str]]) -> str:
    return "\n".join([HEADERS[table], *(",".join(r) for r in rows)]) + "\n"


FILES = {t: text(t, rows) for t, rows in ROWS.items()}


def changed(table: str, key: str, **values: str) -> dict[str, str]:
    """FILES with some fields of one row exchanged."""
    names = [n.strip() for n in HEADERS[table].split(",")]
    rows = [[values.get(n, v) if r[0] == key else v for n, v in zip(names, r, strict=True)] for r in ROWS[table]]
    return {**FILES, table: text(table, rows)}


def write_files(folder: str, files: dict | None = None) -> dict:
    os.makedirs(folder, exist_ok=True)
    out = {}
    for name, body in (files or FILES).items():
        p = os.path.join(folder, f"{name}.csv")
        with open(p, "w") as fh:
            fh.write(body)
        out[name] = p
    return out
