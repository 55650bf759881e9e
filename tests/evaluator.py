"""One contract, event by event, in plain Python: an independent check of the column plans.

It searches its date lists where the library counts months, and carries the states of the
contract from event to event where the library looks them up.
"""

from __future__ import annotations

import calendar
import re
from datetime import date, timedelta

ORDER = {"IED": 1, "IP": 2, "RRF": 3, "RR": 4, "PRD": 5, "TD": 6, "MD": 7}


def add_months(day: date, months: int) -> date:
    year, month = divmod(day.year * 12 + day.month - 1 + months, 12)
    return date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def parse_cycle(text):
    found = re.fullmatch(r"P?(\d+)([DWMQHY])([+-]|L[01])?", text or "")
    if not found or int(found[1]) == 0:
        return None
    months = {"M": 1, "Q": 3, "H": 6, "Y": 12}.get(found[2], 0) * int(found[1])
    days = {"D": 1, "W": 7}.get(found[2], 0) * int(found[1])
    return months, days, found[3] in ("+", "L0")


def moved(day: date, cycle, times: int) -> date:
    return add_months(day, cycle[0] * times) if cycle[0] else day + timedelta(cycle[1] * times)


def regular(anchor, cycle_text, ied: date, md: date) -> list[date]:
    cycle = parse_cycle(cycle_text)
    if cycle is None:
        return []
    anchor = anchor or moved(ied, cycle, 1)
    days, k = [], 0
    while (day := moved(anchor, cycle, k)) <= md:
        days.append(day)
        k += 1
    if days and (days[-1] == md or cycle[2]):
        days.pop()
    return [d for d in days if d > ied]


def year_fraction(a: date, b: date, convention: str) -> float:
    if convention == "A/365":
        return (b - a).days / 365
    if convention == "A/360":
        return (b - a).days / 360
    if convention == "30E/360":
        return ((b.year - a.year) * 360 + (b.month - a.month) * 30 + min(b.day, 30) - min(a.day, 30)) / 360
    days = {365: 0, 366: 0}
    for year in range(a.year, b.year + 1):
        first, last = max(a, date(year, 1, 1)), min(b, date(year + 1, 1, 1))
        days[366 if calendar.isleap(year) else 365] += max((last - first).days, 0)
    return days[365] / 365 + days[366] / 366


def events(c: dict, t0: date, rate_at=lambda code, day: None) -> list[tuple]:
    """``(date, type, value, nominal, accrued)`` of one contract given as a dict of its terms."""
    ied, md, sign = c["initial_exchange_date"], c["maturity_date"], {"RPA": 1, "RPL": -1}[c["role"]]
    td = c.get("termination_date")
    td = td if td and ied <= td <= md else None
    end = td or md
    if end <= t0:
        return []
    paydays = [*regular(c.get("interest_anchor"), c.get("interest_cycle"), ied, md), md]
    resets = regular(c.get("reset_anchor"), c.get("reset_cycle"), ied, md)
    planned = [(ied, "IED")] + [(d, "IP") for d in paydays] + [(md, "MD")]
    prd = c.get("purchase_date")
    prd = prd if prd and prd > t0 and ied <= prd <= end else None
    future = [d for d in resets if t0 < d]
    for rank, day in enumerate(future):
        planned.append((day, "RRF" if rank == 0 and c.get("next_reset_rate") is not None else "RR"))
    planned += [(prd, "PRD")] if prd else []
    planned += [(td, "TD")] if td else []
    planned = sorted(((d, k) for d, k in planned if d > t0), key=lambda e: (e[0], ORDER[e[1]]))
    principal, rate, accrued = sign * c["notional"], c["nominal_rate"], 0.0
    last = max([d for d in paydays if d <= t0], default=ied)
    result = []
    for day, kind in planned:
        if td and (day, ORDER[kind]) > (td, ORDER["TD"]):
            break
        accrued += year_fraction(last, day, c["day_count"]) * rate * principal if day > last else 0.0
        last, value, nominal = max(day, last), 0.0, principal
        if kind == "IED":
            value = -sign * (c["notional"] + (c.get("premium_discount") or 0.0))
        elif kind == "IP":
            value, accrued = accrued, 0.0
        elif kind == "RRF":
            rate = c["next_reset_rate"]
        elif kind == "RR":
            seen = rate_at(c.get("reset_code"), day)
            if seen is not None:
                rate = (1.0 if c.get("rate_multiplier") is None else c["rate_multiplier"]) * seen
                rate += c.get("rate_spread") or 0.0
        elif kind == "PRD":
            value = -sign * c["purchase_price"] - accrued
        else:
            value = (sign * c["termination_price"] if kind == "TD" else principal) + accrued
            nominal = accrued = 0.0
        if not prd or (day, ORDER[kind]) >= (prd, ORDER["PRD"]):
            result.append((day, kind, value, nominal, accrued))
    return result
