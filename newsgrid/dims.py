"""Dictionaries, ranks and thresholds the operators take as parameters.

Everything here is small by construction (a human-maintained configuration), so
the operators compile it into column expressions instead of joining to it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Results depend on these exact words, ranks and numbers.
# --------------------------------------------------------------------------

CATEGORIES = [
    "Leasing & Trading",
    "Aircraft & OEM",
    "Airlines & Credit",
    "Financing & Capital Markets",
    "Engines & MRO",
    "Values & Lease Rates",
    "Legal & Regulatory",
    "Macro & Geopolitics",
]

CORE_SOURCES = ["Ishka Airfinance", "Aviation News Online", "Reuters", "Flightglobal", "FlightGlobal"]

SOURCE_RANK = {
    "Reuters": 100,
    "Ishka Airfinance": 98,
    "FlightGlobal": 96,
    "Flightglobal": 96,
    "Aviation News Online": 92,
    "Bloomberg": 90,
    "Financial Times": 90,
    "Wall Street Journal": 90,
    "Associated Press": 86,
    "CNBC": 84,
}

STOP_WORDS = (
    "a an the and or of to for in on at by from with as is are was were be been being its it this "
    "that these those after before will would could may might into over under new more says said"
).split()

DOMAIN_TERMS = [
    "aircraft", "airline", "aviation", "lessor", "lease", "leasing", "airbus", "boeing", "embraer",
    "comac", "engine", "mro", "fleet", "aercap", "avolon", "boc aviation", "smbc", "air lease",
    "a320", "a321", "a350", "737", "777", "787", "c919", "e190", "e195", "atr",
]

KEYWORDS = {
    "Leasing & Trading": ["lease", "leasing", "lessor", "sale and leaseback", "sale-leaseback", "slb", "remarketing", "trading", "portfolio"],
    "Aircraft & OEM": ["airbus", "boeing", "embraer", "comac", "aircraft order", "orders", "delivery", "deliveries", "production", "backlog", "certification", "a320", "a321", "a350", "737", "777", "787", "c919"],
    "Airlines & Credit": ["airline", "carrier", "bankruptcy", "insolvency", "restructuring", "default", "liquidity", "credit", "profit", "loss", "traffic", "capacity", "fleet", "grounding"],
    "Financing & Capital Markets": ["financing", "finance", "bond", "abs", "securit", "loan", "debt", "jolco", "pdp", "capital markets", "refinanc", "warehouse", "credit facility", "funding"],
    "Engines & MRO": ["engine", "mro", "maintenance", "overhaul", "shop visit", "pratt", "pw1100", "gtf", "cfm", "leap", "rolls-royce", "trent", "spare engine", "repair"],
    "Values & Lease Rates": ["lease rate", "aircraft value", "valuation", "market value", "base value", "residual value", "apprais", "half-life", "full-life"],
    "Legal & Regulatory": ["regulat", "legal", "court", "lawsuit", "litigation", "sanction", "cape town convention", "repossession", "repossess", "compliance", "antitrust", "faa", "easa"],
    "Macro & Geopolitics": ["war", "conflict", "geopolit", "tariff", "oil price", "jet fuel", "interest rate", "inflation", "gdp", "trade war", "airspace", "russia", "ukraine", "iran"],
}

CHANNEL_CATEGORY = {
    "aviationnews_engine": "Engines & MRO",
    "aviationnews_maintenance": "Engines & MRO",
    "aviationnews_legal": "Legal & Regulatory",
    "aviationnews_regulatory": "Legal & Regulatory",
}
CHANNEL_PREFIX_CATEGORY = {"ishka_": "Leasing & Trading"}
DEFAULT_CATEGORY = "Airlines & Credit"

STRONG_TERMS = [
    "bankruptcy", "insolvency", "default", "repossession", "sale and leaseback", "aircraft order",
    "financing", "abs", "jolco", "lease rate", "aircraft value", "gtf", "grounding", "sanction",
    "merger", "acquisition",
]

SEVERE_TERMS = [
    "bankruptcy", "chapter 11", "insolvency", "default", "payment default", "restructuring",
    "repossession", "repossess", "sanction", "grounding", "grounded", "production halt",
    "delivery halt", "airspace closure", "war", "conflict", "credit downgrade", "liquidity crisis",
]

DIRECT_TERMS = [
    "lease", "leasing", "lessor", "sale and leaseback", "sale-leaseback", "slb", "lease rate",
    "aircraft value", "valuation", "residual value", "remarketing", "repossession",
    "aircraft financing", "financing", "refinancing", "jolco", "asset-backed", "abs", "pdp",
    "warehouse facility",
]

CATEGORY_BASE = {
    "Leasing & Trading": 92,
    "Aircraft & OEM": 82,
    "Airlines & Credit": 78,
    "Financing & Capital Markets": 90,
    "Engines & MRO": 86,
    "Values & Lease Rates": 94,
    "Legal & Regulatory": 84,
    "Macro & Geopolitics": 82,
}
CATEGORY_BASE_DEFAULT = 72
MACRO_CATEGORY = "Macro & Geopolitics"

WHY_TEXT = {
    "Leasing & Trading": "直接影响飞机交易、再营销、租金或出租人竞争格局。",
    "Aircraft & OEM": "可能改变新机供给、交付节奏、存量飞机稀缺性与资产价值。",
    "Airlines & Credit": "需要关注承租人信用、现金流、机队调整及潜在租约风险。",
    "Financing & Capital Markets": "可能影响航空资产融资成本、资金可得性和交易定价。",
    "Engines & MRO": "可能影响在翼时间、维修储备、备发需求和飞机可用率。",
    "Values & Lease Rates": "直接关系飞机市场价值、残值和租赁收益水平。",
    "Legal & Regulatory": "可能改变回收、合规、跨境执行或交易结构风险。",
    "Macro & Geopolitics": "可能通过资金成本、燃油、需求、空域或制裁传导至航空租赁市场。",
}
WHY_TEXT_DEFAULT = "可能影响航空公司经营与航空资产风险收益。"
SUMMARY_PREFIX = "根据公开标题与元数据："
CANDIDATE_REASON = "涉及信用、资产回收、停飞、制裁或重大供给冲击。"
REASON_SEVERE = "涉及破产/违约、停飞、制裁、回收或其他可能需要及时关注的重大风险。"
REASON_PRIORITY = ("重点客户/潜在客户 ", " 出现重大经营、机队、融资或交易事件。")
REASON_SYSTEMIC = "宏观或地缘冲击可能系统性传导至航空融资、资产价值、需求或运营风险。"
REASON_OTHER = "对航空租赁市场具有较高即时重要性。"

MODEL_PATTERN = (
    r"A220(?:-\d{3})?|A3(?:19|20|21|30|40|50)(?:neo)?(?:-\d{3,4})?|A380(?:-\d{3})?|"
    r"7(?:37|47|67|77|87)(?:-\d{3,4}| MAX ?\d+)?|E(?:170|175|190|195)(?:-E2)?|"
    r"CRJ(?:200|700|900|1000)|C909|C919|C929|ARJ21|ATR ?(?:42|72)(?:-\d{3})?"
)
ENTITY_PATTERNS = [
    r"\b(?:Airbus|Boeing|Embraer|COMAC|ATR)\b",
    r"\b(?:AerCap|Avolon|BOC Aviation|SMBC Aviation Capital|Dubai Aerospace Enterprise|DAE|CDB Aviation|CALC|"
    r"Air Lease|Aviation Capital Group|ACG|Aircastle|Castlelake|Azorra|TrueNoord|Nordic Aviation Capital|NAC|"
    r"Macquarie AirFinance|ORIX Aviation|Jackson Square Aviation|JSA|Griffin Global Asset Management|SKY Leasing)\b",
    r"\b(?:Pratt\s*&\s*Whitney|Pratt Whitney|GE Aerospace|CFM International|Rolls-Royce|Safran|MTU)\b",
    r"\b(?:" + MODEL_PATTERN + r")\b",
    r"\b(?:PW1100G|PW1500G|LEAP-1[ABC]|CFM56|GEnx(?:-\dB)?|GE9X|Trent ?(?:7000|1000|XWB|700|800|900))\b",
]

_ORDER_WORDS = r"\b(?:firm order|aircraft order|deliver(?:y|ies)|production rate|backlog|certif(?:y|ied|ication))\b"
_MAKER_WORDS = r"\b(?:airbus|boeing|embraer|comac|atr)\b"
LOCK_PATTERNS = {
    "Leasing & Trading": [
        r"\bsale[- ]and[- ]leaseback\b",
        r"\baircraft leasing deal\b",
        r"\baircraft lease agreement\b",
        r"\baircraft portfolio (?:sale|acquisition|purchase)\b",
        r"\b(?:lease placement|lease extension|remarketing mandate)\b",
    ],
    "Aircraft & OEM": [
        _MAKER_WORDS + ".{0,90}" + _ORDER_WORDS,
        _ORDER_WORDS + ".{0,90}" + _MAKER_WORDS,
    ],
    "Airlines & Credit": [
        r"\b(?:bankruptcy|chapter 11|insolvency|insolvent|payment default|credit downgrade|liquidity crisis)\b",
        r"\bairline restructuring\b",
    ],
    "Financing & Capital Markets": [
        r"\baircraft financ(?:e|ing)\b",
        r"\baviation (?:abs|asset[- ]backed securiti[sz]ation)\b",
        r"\basset[- ]backed securiti[sz]ation\b",
        r"\bjolco\b",
        r"\bpdp financ(?:e|ing)\b",
        r"\bwarehouse facilit(?:y|ies)\b",
    ],
    "Engines & MRO": [
        r"\b(?:gtf|pw1100g|pw1500g|leap-1[abc]|cfm56|genx|ge9x|trent xwb|trent 1000|trent 7000)\b",
        r"\b(?:engine shop visit|engine overhaul|engine maintenance|spare engine)\b",
        r"\bmro\b",
    ],
    "Values & Lease Rates": [
        r"\b(?:lease rate|lease rates|market value|base value|residual value|aircraft valuation|aircraft appraisal)\b",
    ],
    "Legal & Regulatory": [
        r"\bcape town convention\b",
        r"\b(?:court ruling|lawsuit|litigation|legal dispute)\b",
        r"\b(?:faa|easa) airworthiness directive\b",
    ],
    "Macro & Geopolitics": [
        r"\b(?:airspace closure|airspace closed|geopolitical conflict|trade war)\b",
        r"\b(?:oil price|jet fuel price|interest rate|tariff)\b",
    ],
}

TRACKING_KEYS = ["ref", "source", "campaign", "mc_cid", "mc_eid"]
TRACKING_PREFIX = "utm_"
REDIRECT_KEYS = ["url", "u", "r"]

LISTING_REGIONS = [
    "Americas", "Asia/Pacific", "Europe", "Middle East/Africa", "Oceania", "Africa",
    "Latin America", "Southeast Asia", "Middle East",
]

MATERIAL_TERMS = [
    "bankruptcy", "chapter 11", "insolvency", "default", "restructuring", "liquidity", "credit downgrade",
    "rating downgrade", "grounding", "grounded", "engine issue", "engine shortage", "gtf", "shop visit",
    "maintenance disruption", "aircraft order", "orders", "delivery", "deliveries", "production", "backlog",
    "certification", "fleet plan", "fleet renewal", "sale and leaseback", "sale-leaseback", "slb", "lease",
    "leasing", "lessor", "remarketing", "repossession", "repossess", "financing", "refinancing", "bond", "abs",
    "jolco", "pdp", "loan", "credit facility", "capital markets", "merger", "acquisition", "takeover",
    "joint venture", "sanction", "tariff", "airspace closure", "war", "conflict",
]

MACRO_TOPICS = {
    "Rates & Funding": ["interest rate", "rates", "yield", "bond yield", "credit spread", "funding cost", "liquidity", "refinancing", "usd", "dollar", "sofr"],
    "Fuel & Energy": ["oil price", "brent", "jet fuel", "kerosene", "fuel price", "energy price"],
    "Geopolitics & Airspace": ["war", "conflict", "geopolitical", "airspace", "sanction", "russia", "ukraine", "iran", "middle east", "red sea"],
    "Trade & Supply Chain": ["tariff", "trade war", "supply chain", "parts shortage", "supplier", "export control", "import duty"],
    "Macro Demand": ["gdp", "recession", "inflation", "consumer demand", "travel demand", "passenger traffic", "capacity growth", "rpk", "ask"],
    "OEM Supply": ["production rate", "production ramp", "delivery delay", "deliveries", "backlog", "certification delay", "quality issue"],
    "Regulation & Recovery": ["cape town convention", "repossession", "insolvency law", "aviation regulation", "faa", "easa", "sanctions regime"],
}

# --------------------------------------------------------------------------
# Configuration
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Entity:
    name: str
    type: str
    aliases: tuple[str, ...]


@dataclass(frozen=True)
class PriorityConfig:
    """Watch list and ranking knobs. Load the owner's own list with ``from_json``."""

    entities: tuple[Entity, ...] = ()
    topics: dict = field(default_factory=lambda: dict(MACRO_TOPICS))
    material_terms: tuple[str, ...] = tuple(MATERIAL_TERMS)
    entity_floor: int = 86
    material_floor: int = 92
    entity_boost: int = 22
    multi_entity_bonus: int = 4
    macro_floor: int = 83
    systemic_floor: int = 88

    @staticmethod
    def from_json(path: str) -> "PriorityConfig":
        with open(path, encoding="utf-8") as handle:
            raw = json.load(handle)
        base = PriorityConfig()
        return PriorityConfig(
            entities=tuple(
                Entity(e["canonical"], e.get("type", ""), tuple(e.get("aliases") or [e["canonical"]]))
                for e in raw.get("entities", [])
            ),
            topics={t["tag"]: t.get("terms", []) for t in raw.get("macro_topics", [])},
            material_terms=tuple(raw.get("material_event_terms", [])),
            entity_floor=int(raw.get("priority_entity_floor", base.entity_floor)),
            material_floor=int(raw.get("priority_material_event_floor", base.material_floor)),
            entity_boost=int(raw.get("priority_entity_boost", base.entity_boost)),
            multi_entity_bonus=int(raw.get("multiple_priority_entity_bonus", base.multi_entity_bonus)),
            macro_floor=int(raw.get("macro_relevance_floor", base.macro_floor)),
            systemic_floor=int(raw.get("systemic_macro_floor", base.systemic_floor)),
        )


# A small watch list for the registered queries; production runs load their own JSON.
SAMPLE_CONFIG = PriorityConfig(
    entities=(
        Entity("Airbus", "OEM", ("Airbus", "空客")),
        Entity("Boeing", "OEM", ("Boeing", "波音")),
        Entity("Air China", "Airline", ("Air China", "国航")),
        Entity("Chang'an Airlines", "Airline", ("Chang'an Airlines", "长安航空")),
        Entity("SAS", "Airline", ("SAS", "Scandinavian Airlines")),
        Entity("Air France-KLM", "Airline Group", ("Air France-KLM", "法荷航集团")),
        Entity("KLM Royal Dutch Airlines", "Airline", ("KLM", "KLM Royal Dutch Airlines")),
        Entity("Wizz Air", "Airline", ("Wizz Air", "Wizz")),
        Entity("Korean Air", "Airline", ("Korean Air", "大韩航空")),
        Entity("International Airlines Group", "Airline Group", ("IAG", "IAG集团")),
        Entity("The Thereal", "Airline", ("thatin", "inoran")),
        Entity("Hehely", "Lessor/Financing", ("hehely", "orantion", "ononst")),
    )
)
