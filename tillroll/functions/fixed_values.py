"""Fixed values of the product text treatment.

Word lists, patterns and replacements that results depend on. Order matters
within each list: a rule sees the text the rules before it left.
Replacements use ``$1`` for group 1.
"""

# Units and packs.
UNIT_RULES = [
    (r"s/", " sem "),
    (r"(c/|\sc\s)", " com "),
    (r"\b(\d+)(x|\s+x)(\d+|\s+\d+)", "$1unidade $3"),
    (r"\b(\d+|\d+\s+)(un|unidad|unid|und)\b", "$1unidade "),
    (r"\b(caixa|caixa com|cx|cxa)(\s+\d+|\d+)(|un)((\s+)(unidades?))?\b", "$2unidade "),
    (r"(pack( de| com)?)(\s+)(\d+)((\s+)(unidades?))?", "$4unidades"),
    (r"sixpack|six pack", "6unidade"),
    (r"twelvepack|twelve pack", "12unidade"),
]

# Litres: whole part, separator, fraction, spaces, unit word, end.
LITRE_PATTERN = r"(\d+)(,|\.|\s+|)(\d+|)(\s+|)(lts|ltr|lt|lits|litros|litro|l)(\s+|$)"
LITRE_WORDS = (r"litrao|litro", " 1000ml ")

# Millilitres.
ML_RULES = [
    (r"(\d+)(\s+|)(ml|m)(\s+|$)", " $1$3 "),
    (r"(\d+)(m)(\s+|$)", "$1ml "),
]

# After the volume rules.
UNIT_GLUE_RULES = [
    (r"\b(\d+)\s(unidade)", "$1$2"),
    (r"0(\d+unidade)", "$1"),
]

# Brand and packaging words.
BRAND_RULES = [
    (r"(transf.|transferencia|transf)\s+de\s+mesa\s+\d+", ""),
    (r"(beck's\b)|(beck( s|\b))", "becks"),
    (r"coca( [^c]|$)|com\s+cola|colacola|cola\s+cola|coca( |)cola", "coca-cola"),
    (r"refguarana", "refrigerante guarana"),
    (r"refpet", "refrigerante pet"),
    (r"serra(\s+|)(malte|malt|m )", "serramalte"),
    (r"#(.*)#", ""),
    (r"n/a|#\d+ |[^A-Za-z0-9|]+", " "),
    (r"\s+(one|on|o)\s+(way|w)(\s+|$)", " ow "),
    (r"oneway", "ow"),
    (r"(\s|^)(long neck|long nek|long n|l neck|l n )", " ln "),
    (r"com gas", "comgas"),
    (r"sem gas", "semgas"),
    (r"sub zero", "subzero"),
    (r"\bjesus guarana\b", "guarana jesus"),
    (r"\bbrahma (chopp\b|chop\b)", "brahma"),
    (r"\bproibida pilsen\b", "proibida"),
    (r"antarcti\b", "antarctica"),
    (r"\b150 bpm\b", "150bpm"),
    (r"\bnao informado\b", ""),
    (r"\b(zer|zr)\b", "zero"),
]

# Patterns that find the same, or all but what they would replace by itself, at less cost:
# what a match starts with is tested before a word border, and a single space between two
# words stays without being replaced by a space.
FASTER = {
    r"n/a|#\d+ |[^A-Za-z0-9|]+": (
        r"(?![A-Za-mo-z0-9|])(?:n/a|#\d+ |(?! [A-Za-z0-9|])[^A-Za-z0-9|]+)"
    ),
    **{p: r"(?=\d)" + p for p in (UNIT_RULES[2][0], UNIT_RULES[3][0], UNIT_GLUE_RULES[0][0])},
    UNIT_RULES[4][0]: r"(?=c)" + UNIT_RULES[4][0],
    r"\bjesus guarana\b": r"(?=j)\bjesus guarana\b",
    r"\bbrahma (chopp\b|chop\b)": r"(?=b)\bbrahma (chopp\b|chop\b)",
    r"\bproibida pilsen\b": r"(?=p)\bproibida pilsen\b",
    r"\b150 bpm\b": r"(?=1)\b150 bpm\b",
    r"\bnao informado\b": r"(?=n)\bnao informado\b",
    r"\b(zer|zr)\b": r"(?=z)\b(zer|zr)\b",
}

# Full word -> its abbreviations.
ABBREVIATIONS = {
    "refrigerante": ["refri", "refrig", "refr", "ref", "refriger"],
    "cerveja": ["cerv", "cervej", "cer", "cerve"],
    "chopp": ["chop"],
    "tonica": ["ton", "tonic"],
    "itaipava": ["itpv", "itaip"],
    "do bem": ["db"],
    "h2oh": ["h2o", "h20h", "h20"],
    "antarctica": [
        "antartica", "ant", "antar", "antart", "antartc", "antarct", "antarctic", "antarc",
        "antartic",
    ],
    "schweppes": ["schw"],
    "guarana": ["guar", "guara", "guarah"],
    "heineken": ["heinek"],
    "laranja": ["lar", "laran", "lja"],
    "limao": ["lim"],
    "maCZbier": ["malizbier"],
    "pilsen": ["pil", "pils"],
    "budweiser": ["bud", "budweis"],
    "alcool": ["alc"],
    "brahma": ["brama", "ahma"],
    "original": ["orig", "origina", "origin", "ori"],
    "agua": ["ag"],
    "coca cola": ["cocacola"],
    "pepsi": ["pespi"],
    "sprite": ["sprit"],
    "mineral": ["min"],
    "stella": ["stela"],
    "caixa": ["cx", "cxa"],
    "unidade": ["un", "uni", "unidad", "und"],
    "lt": ["lata", "latao", "latagelada", "latas", "lat", "lta"],
    "garrafa": ["gf", "gfa", "grfa", "grf"],
    "ln": ["lneck", "longnec", "lnk", "long", "lon"],
    "zero": ["sacucar"],
    "puro malte": ["pmalte"],
    "senses": ["sense", "sens"],
    "garrafa 300ml": ["litrinho"],
}

STOP_WORDS = ["atac", "beb", "irrelevante", "cl", "retornavel", "retorn", "gelada", "atcd"]

# Phrases kept together before the treatment (case-insensitive).
BRAND_PHRASES = [("(?i)OUTRA MARCA", "OUTRAMARCA")]
PRODUCT_PHRASES = [("(?i)DO BEM", "DOBEM"), ("(?i)JOTA EFE", "JOTAEFE")]

# Words that count as packaging in the number description.
PACKAGE_WORDS = ["garrafa", "pet", "lt", "barril", "draft"]
UNIT_WORD = "unidade"
DEFAULT_UNIT = " 1unidade"
VOLUME_SUFFIX = "ml"

# Key terms added to every vocabulary.
KEY_TERMS = [
    "do bem", "ln", "ow", "budweiser", "bohemia", "brahma", "skol", "antarctica", "wals", "beats",
    "pilsen", "ml", "misto", "garrafa",
]
TYPO_CUTOFF = 0.90

# Source whose own volume and pack count win over the catalogue's.
OWN_VOLUME_SOURCE = "SCANNTECH"
OWN_VOLUME_SUBSOURCE = "DIAFULL"

# Match labels, by stage.
MATCH_EAN = "EAN"
MATCH_NAME = "DESCRICAO"
MATCH_TREATED = "DESCRICAO_TRATADA"

AUDIT_MARK = "AUDIT"
FACTORY_SOURCE = "FABRICA"
