"""A small shop extract as CSV text, with one of every fault the job handles.

22, 51 and 40 rows that have to come out as 20, 45 and 35.
"""

from __future__ import annotations

from pathlib import Path


def customers() -> list[str]:
    lines = ["customer_id,name,signup_date,country"]
    countries = ["india", "INDIA", " India ", "uSA", "guinea-bissau", "new zealand"]
    for i in range(1, 21):
        date = f"2024-01-{i:02d}"
        if i == 3:
            date = "not_a_date"
        elif i % 4 == 0:
            date = f"{i:02d}-01-2024"
        elif i % 5 == 0:
            date = f"2024/01/{i:02d}"
        elif i % 7 == 0:
            date = f"01/{i:02d}/2024"
        lines.append(f"{i},Customer {i},{date},{countries[i % 6]}")
    lines.append("5,Customer 5 again,2020-01-01,nowhere")
    lines.append("21,,2024-01-21,india")
    return lines


def orders() -> list[str]:
    lines = ["order_id,customer_id,order_date,amount,status"]
    status = ["Completed", " PENDING ", "cancelled"]
    for i in range(1, 51):
        customer = 21 if i in (10, 20, 30) else 22 if i in (40, 50) else i % 18 + 1
        lines.append(f"{i},{customer},{i % 28 + 1:02d}-02-2024,{i}.50,{status[i % 3]}")
    lines.append("11,12,01-01-2020,9999,completed")
    return lines


def payments() -> list[str]:
    lines = ["payment_id,order_id,payment_date,payment_status"]
    orphans = {4: 55, 8: 10, 12: 20, 16: 40, 20: 50}
    good = [i for i in range(1, 50) if i not in (10, 20, 30, 40)]
    for i in range(1, 41):
        order = orphans.get(i, good[i])
        state = " SUCCESS" if i % 2 else "Failed"
        lines.append(f"{i},{order},2024/02/{i % 28 + 1:02d},{state}")
    return lines


def write(folder: Path) -> dict[str, str]:
    paths = {}
    for make in (customers, orders, payments):
        path = folder / f"{make.__name__}.csv"
        path.write_text("\n".join(make()) + "\n")
        paths[make.__name__] = str(path)
    return paths
