"""Rule tables that queries and classifiers share.

Sites differ in hosts and brand words; everything here can be replaced by passing other
tables to the functions that use them.
"""

from __future__ import annotations

# --- fixed values: query parameters that do not change a page ---
NOISE_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "fbclid", "gclid", "ref", "_ga", "_gl", "mc_cid", "mc_eid",
    "csrt", "sc_camp", "sc_trk", "sc_device", "sc_debug", "sc_prof",
    "sc_ritm", "sc_rb", "cshid", "timestamp", "_t",
]

# --- fixed values: URL patterns ---
SKIP_PATTERNS = [
    r"\.(jpg|jpeg|png|gif|svg|webp|ico|css|js|woff2?|ttf|eot|mp4)(\?|$)",
    r"/(login|signin|logout|register|otp|netbanking|ib/|onlinebanking)",
    r"[?&](utm_|fbclid|gclid)",
    r"#",
    r"/search\?",
]
PDF_PATTERN = r"\.pdf(\?|$)"
ATTACHMENT_PATTERNS = [r"\.(pdf|xlsx?|docx?|pptx?|csv|zip|rtf)(\?|$)", r"\.ashx(\?|$)", r"/-/media/", r"/download", r"/attachment"]

# --- fixed values: page type, segment and path markers ---
NEWS = r"(news|press|media|article|blog|event|celebrat|announce|awards?|csr|sustainab|initiative|campaign|day\b|anniversar|sponsor)"
ABOUT = r"(about|who-?we-?are|history|board|governance|management|investor|career|jobs|vacanc|contact|branch|atm|locations?|sitemap|privacy|terms)"
PRODUCT = r"(product|cards?|accounts?|loans?|deposits?|certificates?|savings?|finance|financing|mortgage|insurance|transfers?|services?|tariff|fees?|rates?|personal|retail|individual)"
CORPORATE = r"(corporate|business|enterprise|company|companies|commercial|institution|wholesale|trade-?finance|payroll)"
CONSUMER = r"(personal|individual|retail|consumer|private|youth|student)"
PATH_CONSUMER = r"^(retail[\s_-]*banking|personal[\s_-]*banking|individual|consumer|retail|personal)$|retail[\s_-]*banking"
PATH_CORPORATE = r"corporate[\s_-]*banking|^corporate$|companies[\s_-]*cards?|^companies$|business[\s_-]*banking|^corporates?$"
PATH_IGNORE = r"^(smes?|home|pages|en|ar|index)$"

# --- fixed values: query intents (cues, heading words) in order, and topics ---
INTENTS = {
    "eligibility": (
        [r"eligib", r"qualif", r"who can (apply|get)", r"requirements? (for|to)", r"criteria", r"minimum (income|salary|age)", r"am i eligible", r"شروط", r"الاستحقاق", r"من يستطيع", r"الحد الادنى"],
        ["eligibility", "eligible", "criteria", "requirements", "who can apply", "conditions", "شروط", "الاستحقاق", "المؤهلات"],
    ),
    "documents": (
        [r"documents?", r"paperwork", r"what do i need", r"required to open", r"needed to open", r"how (do i|to) open", r"مستندات", r"اوراق", r"المطلوبة", r"فتح حساب"],
        ["documents", "required documents", "requirements", "how to apply", "how to open", "steps", "المستندات", "المستندات المطلوبة", "الاوراق"],
    ),
    "fees": (
        [r"\bfees?\b", r"charges?", r"commission", r"annual fee", r"cost", r"tariff", r"how much", r"price", r"رسوم", r"عمولة", r"تكلفة", r"التعريفة", r"كم تكلفة"],
        ["fee", "fees", "charges", "commission", "tariff", "pricing", "cost", "رسوم", "الرسوم", "العمولات", "التعريفة"],
    ),
    "rates": (
        [r"interest rate", r"\brates?\b", r"return", r"yield", r"profit rate", r"عائد", r"فائدة", r"سعر الفائدة"],
        ["rate", "rates", "interest", "return", "yield", "عائد", "فائدة"],
    ),
    "compare": (
        [r"compare", r"comparison", r"difference between", r"which (card|account)", r"best (card|account)", r"options", r"types of", r"قارن", r"مقارنة", r"الفرق بين", r"انواع"],
        [],
    ),
    "benefits": (
        [r"benefits?", r"rewards?", r"advantages?", r"features?", r"perks?", r"مزايا", r"فوائد", r"مكافآت"],
        ["benefits", "features", "advantages", "rewards", "مزايا", "الفوائد"],
    ),
}
TOPICS = {
    "cards": r"(cards?|visa|mastercard|credit card|debit card|prepaid|بطاق|بطاقات|ائتمان)",
    "accounts": r"(accounts?|current account|savings|deposit|حساب|حسابات|ودائع|توفير)",
    "loans": r"(loans?|financ|mortgage|credit facilit|قرض|قروض|تمويل)",
}

# --- fixed values: tokenizer ---
STOPWORDS = ["the", "a", "an", "of", "for", "and", "or", "to", "in", "on", "at", "is", "are", "what", "which", "do", "does", "i", "my", "me", "you", "your", "من", "في", "على", "الى", "إلى", "عن", "ما", "هي", "هو", "و", "او", "أو"]
ARABIC_MARKS = "[ً-ْـ]"
ARABIC_FROM, ARABIC_TO = "آأإٱةى٠١٢٣٤٥٦٧٨٩", "ااااهي0123456789"
ARABIC_PUNCT = "[،؛؟٪-٭۔«»]"
ARABIC_BLOCKS = "؀-ۿݐ-ݿﭐ-﷿ﹰ-﻿"

# --- fixed values: ranking ---
RRF_K = 60
BOOST_UNIT = 1.0 / 61 - 1.0 / 71
DENSE_WEIGHT, BM25_WEIGHT = 1.0, 0.55
BOOSTS = {"heading_match": 2.0, "page_product": 0.6, "page_news": -2.5, "page_about": -1.2, "segment_mismatch": -1.5, "has_table_fee_query": 0.8, "pdf_fee_query": 0.5}

# --- fixed values: responses that are not content ---
NOT_FOUND_MARKERS = ["page not found", "page cannot be found", "page you requested", "page doesn't exist", "page does not exist", "404", "not be found", "الصفحة غير موجودة", "غير متوفرة"]
CHALLENGES = {
    "cloudflare": ["cf-browser-verification", "checking your browser", "attention required", "cf_chl", "ray id"],
    "f5_asm_block": ["support id", "this request has been temporarily blocked", "temporarily blocked", "the requested url was rejected"],
    "bot_protection": ["access denied", "request blocked", "are you a robot", "incapsula", "imperva", "akamai reference", "suspicious activity", "quote your support id"],
    "cookie_consent": ["onetrust", "cookie consent", "we use cookies", "accept all cookies", "cookiebot"],
    "js_required": ["enable javascript", "javascript is disabled", "requires javascript"],
}
BLOCKING = ["cloudflare", "f5_asm_block", "bot_protection"]

# --- fixed values: file signatures and content types ---
MAGIC = [
    (b"%PDF-", "pdf", ".pdf"), (b"PK\x03\x04", "office_or_zip", ".zip"), (b"\xd0\xcf\x11\xe0", "office_legacy", ".doc"), (b"\xff\xd8\xff", "image", ".jpg"),
    (b"\x89PNG\r\n", "image", ".png"), (b"II*\x00", "image", ".tif"), (b"MM\x00*", "image", ".tif"), (b"{\\rtf", "rtf", ".rtf"),
]
CONTENT_TYPES = {
    "application/pdf": ".pdf", "application/x-pdf": ".pdf", "application/vnd.ms-excel": ".xls",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": ".xlsx", "application/msword": ".doc",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": ".docx", "application/vnd.ms-powerpoint": ".ppt",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": ".pptx", "text/csv": ".csv", "application/zip": ".zip",
    "application/octet-stream": ".bin", "image/jpeg": ".jpg", "image/png": ".png", "image/tiff": ".tif",
}

# --- fixed values: corpus gate ---
REQUIRED_FIELDS = ["url", "title", "fetched_at", "content_hash", "language"]
TASK_TERMS = ["credit card", "eligibility", "fee", "account", "document", "interest rate", "loan"]
