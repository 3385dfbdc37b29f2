"""Plain sequential models of the three attributions, one visitor at a time.

They follow the rule table row by row with explicit state, unlike the library, and are
used as brute force on small histories.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from urllib.parse import urlsplit

from touchpath import config as c

OWN = "fundhub"
GROUP_OF_ENTRY = {c.DIRECT: c.ALL_DIRECT}


def blank(value, any_case=False):
    return value in ("", "null") or (any_case and value.lower() == "null")


def internal(url):
    return re.search(rf"https?://.*\.e?{OWN}", url) is not None


def ref_channel(url):
    """Code, or None; raises ValueError for a malformed URL (here: one with a space)."""
    if " " in url:
        raise ValueError(url)
    host = urlsplit(url).hostname or ""
    for domain, code in c.REFERRER_DOMAINS:
        if domain in host:
            return code
    return None


def tag(htag):
    """(level, body) of a valid tag, else None."""
    if re.fullmatch(r"[0-3]\.\d{6,}", htag):
        return htag.split(".", 1)
    return None


def is_promo(code):
    return re.fullmatch(r"\d{10}90{5}", code) is not None


def levels(channel):
    return [channel[:3], channel[:6], channel[:10]] if is_promo(channel) else [channel]


def group(channel):
    if channel == c.DIRECT:
        return c.ALL_DIRECT
    if channel in c.SEARCH_CODES:
        return c.ALL_SEARCH
    return c.ALL_PROMO if is_promo(channel) else c.ALL_OTHER


class Tally:
    """Everything one report counts."""

    def __init__(self):
        self.pv, self.simu, self.enter = Counter(), Counter(), Counter()
        self.channel = {}

    def report(self, views_by_guid, simu_by_guid):
        out = {}
        for guid, views in views_by_guid.items():
            for code, n in views.items():
                row = out.setdefault(code, Counter())
                row["pv"] += n
                row["uv"] += 1
                row["validuv"] += n > 1
                row["simuuv"] += simu_by_guid[guid][code] > 0
        return out


def pc_model(rows):
    """rows: dicts with id, guid, ts, srcurl, htag, pageid. Returns (channels, report, enter)."""
    by_guid = defaultdict(list)
    for row in rows:
        by_guid[row["guid"]].append(row)
    channels, enter = {}, Counter()
    views, simus = defaultdict(Counter), defaultdict(Counter)
    for guid, history in by_guid.items():
        current, been_direct = None, False
        for row in sorted(history, key=lambda r: r["ts"]):
            src, htag = row["srcurl"], row["htag"]
            counted = None
            has_tag, parts = not blank(htag), tag(htag)
            if has_tag and parts and not blank(src) and internal(src):
                pass
            elif has_tag and parts and parts[0] == "0":
                if not is_promo(parts[1]):
                    continue
                current = parts[1]
                enter.update(levels(current))
                enter[c.ALL_PROMO] += 1
            elif has_tag and blank(src):
                enter[c.DIRECT] += 1
                if been_direct:
                    counted = c.DIRECT
                else:
                    current, been_direct = c.DIRECT, True
            elif not blank(src) and not internal(src):
                try:
                    current = ref_channel(src) or c.OTHER
                    enter[current] += 1
                    enter[group(current)] += 1
                except ValueError:
                    current = c.OTHER
                    enter[c.OTHER if has_tag and not parts else c.ALL_OTHER] += 1
            if current is None:
                current, been_direct = c.DIRECT, True
                enter[c.DIRECT] += 1
            channel = counted or current
            channels[row["id"]] = channel
            if channel in c.PORTAL_CODES:
                continue
            simu = not blank(row["pageid"]) and row["pageid"].endswith("2")
            for code in [*levels(channel), group(channel), c.ALL]:
                views[guid][code] += 1
                simus[guid][code] += simu
    enter[c.ALL_DIRECT] = enter[c.DIRECT]
    enter[c.ALL] = sum(enter[g] for g in c.GROUPS)
    return channels, Tally().report(views, simus), +enter


def h5_model(rows):
    """Channel per row id, and entry counts."""
    by_guid = defaultdict(list)
    for row in rows:
        by_guid[row["guid"]].append(row)
    channels, enter = {}, Counter()

    def enters(channel):
        enter.update([*levels(channel), group(channel), c.ALL])

    for history in by_guid.values():
        current = None
        for row in sorted(history, key=lambda r: r["ts"]):
            src, htag = row["srcurl"], row["htag"]
            parts = None if blank(htag, True) else tag(htag)
            new = None
            if parts and parts[0] == "0":
                new = parts[1] if is_promo(parts[1]) else None
            elif blank(src, True):
                new = c.DIRECT
            elif parts or not internal(src):
                try:
                    new = ref_channel(src) or c.OTHER
                except ValueError:
                    new = c.OTHER
            elif current is None:
                new = c.DIRECT
            if new is None and current is None:
                new = c.DIRECT
            if new is not None:
                current = new
                enters(new)
            channels[row["id"]] = current
    return channels, enter


def otrack_model(value):
    """Channel of an otrack value, None for a blank one."""
    if blank(value, True):
        return None
    if not re.fullmatch(r"\d+-\d+-\d+-\d+\.[0-3]", value):
        return c.OTHER
    body = value.split(".")[0].split("-")[0]
    if body == "0":
        return c.DIRECT
    known = is_promo(body) or re.fullmatch(c.SEARCH, body) or body in (c.DIRECT, c.OTHER)
    return body if known else c.OTHER


def trade_model(rows):
    """Report of the trades: code -> (persons, bills, amt, bind_card, open_acct)."""
    by_guid = defaultdict(list)
    for row in rows:
        by_guid[row["guid"]].append(row)
    total = defaultdict(lambda: [0, 0, 0, 0, 0])
    for code in (*c.GROUPS, c.ALL):
        total[code]
    for history in by_guid.values():
        current, traded, amounts = None, set(), Counter()
        for row in sorted(history, key=lambda r: r["ts"]):
            current = otrack_model(row["otrack"]) or current or c.DIRECT
            g = group(current)
            for code in [*levels(current), g, c.ALL]:
                line = total[code]
                if row["type"] in c.TRADE_ACTIONS:
                    line[1] += 1
                    if code != c.ALL:
                        line[2] += row["amt"]
                    traded.add(code)
                line[3] += row["type"] == "5"
                line[4] += row["type"] == "4"
            if row["type"] in c.TRADE_ACTIONS:
                amounts[g] += row["amt"]
        positive = sum(a for a in amounts.values() if a > 0)
        total[c.ALL][2] += positive
        total[c.ALL][0] += positive > 0
        for code in traded:
            if code in c.GROUPS:
                total[code][0] += amounts[code] > 0
            elif code != c.ALL:
                total[code][0] += 1
    return {code: tuple(line) for code, line in total.items()}
