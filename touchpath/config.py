"""Fixed values and site settings shared by every report.

The codes, patterns and lookup rows below are fixed values: they are part of the
data contract with the log producers and the report tables, so they are listed
as they are. Everything that differs per installation (site name, statistic
date, table names, connection settings, keys) is a parameter.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# --- fixed values: log format ------------------------------------------------
FIELD_SEPARATOR = "\u0001"
# every character with the Unicode White_Space property
WHITE_SPACE = (
    "\t\n\u000b\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
VISITOR_PREFIX = "0x"

# --- fixed values: channel codes ---------------------------------------------
DIRECT = "9999999999"
OTHER = "9999999998"
ALL_SEARCH = "9999999997"
ALL_PROMO = "9999999996"
ALL_OTHER = "9999999995"
ALL_DIRECT = "9999999994"
ALL = "9999999993"
GROUPS = (ALL_SEARCH, ALL_PROMO, ALL_OTHER, ALL_DIRECT)

# --- fixed values: tag patterns (whole-string matches) -----------------------
HTAG = r"^[0-3]\.\d{6,}$"
OTRACK = r"^\d+-\d+-\d+-\d+\.[0-3]$"
PROMO = r"^\d{10}90{5}$"
SEARCH = r"^[1-6]80{5}$"
PROMO_CODE = r"^(\d{3}|\d{6}|\d{10})$"
PROMO_LENGTHS = (3, 6, 10)

# --- fixed values: referrer host -> channel code -----------------------------
# When a host contains more than one of the domains, the first row wins.
REFERRER_DOMAINS = (
    ("hao123.com", "10800000"),
    ("ifeng.com", "8800000"),
    ("google.com", "3800000"),
    ("bing.com", "5800000"),
    ("go.uc.cn", "9800000"),
    ("sina.com.cn", "11800000"),
    ("baidu.com", "2800000"),
    ("qq.com", "7800000"),
    ("haosou.com", "4800000"),
    ("youdao.com", "12800000"),
    ("sogou.com", "1800000"),
    ("maxthon.cn", "13800000"),
    ("sm.cn", "6800000"),
)
SEARCH_CODES = ("1800000", "2800000", "3800000", "4800000", "5800000", "6800000")
PORTAL_CODES = (
    "7800000", "8800000", "9800000", "10800000", "11800000", "12800000", "13800000",
)

# --- fixed values: products, modules, actions --------------------------------
PRODUCT_EXCLUDED_ON_PC = "5001"
PRODUCT_H5 = "5002"
MODULE_PRIVATE_FUND = "10011"
MODULE_NEWS = "10012"
MODULE_AD = "10013"
MODULES = {"10011": "私募", "10012": "资讯", "10013": "网站广告"}

ACTION_OPEN_ACCOUNT = "4"
ACTION_BIND_CARD = "5"
ACTION_BUY_FUND = "6"
ACTION_SAVE = "8"
ACTION_PLAN = "10"
TRADE_ACTIONS = (ACTION_BUY_FUND, ACTION_SAVE, ACTION_PLAN)
REPORTED_ACTIONS = (ACTION_OPEN_ACCOUNT, ACTION_BIND_CARD) + TRADE_ACTIONS
ACTIONS = {
    "1": "登录", "2": "预约", "3": "订阅", "4": "开户", "5": "绑卡", "6": "买基金",
    "7": "赎回", "8": "储蓄罐存入 ", "9": "储蓄罐取现 ", "10": "定投", "11": "转换 ",
    "12": "撤单",
}
FAILURE_COUNTERS = {"6": "BUY_FAILED", "8": "SAVING_FAILED", "10": "SAVINGPLAN_FAILED"}

# --- fixed values: page ids --------------------------------------------------
NEWS_PAGE = r"^\d{13,}3$"
PRIVATE_FUND_PAGE = r"^\d+(1|2|3)2$"
FUNNEL_SUFFIXES = {
    "huodong_index": "6",
    "openacct_index": "21000",
    "auth_index": "21010",
    "open_result_index": "21020",
}

# --- fixed values: ads, apps -------------------------------------------------
AD_TAG = r"^1\d{4}$"
AD_TAG_RESERVED = "10000"
APP_SAVINGS = ("2001", "2002")
APP_FUND = ("3001", "3002")
APP_ANDROID = ("2002", "3002")
APP_IOS = ("2001", "3001")
DEVICE_ID_UNUSABLE = r"^(0+|-+|\s*)$"

# Money is parsed and summed exactly in this type. Amounts with more decimals, or so large
# that sums could overflow, are rejected, never rounded.
AMOUNT_SCALE = 6
AMOUNT_TYPE = f"decimal(38,{AMOUNT_SCALE})"
AMOUNT_LIMIT = 10**18
ID_TYPE = "decimal(38,0)"  # numbers in page ids, exact up to 38 digits
AMOUNT_TEXT = rf"^[+-]?(\d+(\.\d{{0,{AMOUNT_SCALE}}}0*)?|\.\d{{1,{AMOUNT_SCALE}}}0*)([eE]\+?\d{{1,2}})?$"


@dataclass(frozen=True)
class Site:
    """Host labels under which the site's own pages are served.

    ``labels[0]`` is the main label (``www.<label>.com``); further labels are aliases.
    """

    labels: tuple[str, ...] = ("fundhub", "efundhub")

    @property
    def _alternatives(self) -> str:
        return "|".join(re.escape(label) for label in self.labels)

    @property
    def landing(self) -> str:
        """Own pages, except hosts starting with the mobile/topic/data prefixes."""
        return rf"(?:http|https)://((?!m|mzt|zt|data).*)\.(?:{self._alternatives})"

    @property
    def internal(self) -> str:
        return rf"(?:http|https)://.*\.(?:{self._alternatives})"

    @property
    def private_fund(self) -> str:
        return rf"^(?:http|https)://.*(?<=simu\.{re.escape(self.labels[0])})\.com.*$"


DEFAULT_SITE = Site()
