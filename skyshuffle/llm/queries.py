"""The registered queries of this sub-package, and their SQL where SQL can express them."""

from .decontaminate import OP9_SQL, op9_decontamination
from .extraction import op8_html_extraction
from .jaccard import op3_ngram_jaccard
from .language import op2_language
from .mixing import op10_mixing
from .quality import op5_quality
from .substrings import OP6_SQL, op6_substring_dedup
from .topk import OP4_SQL, op4_topk
from .urls import OP7_SQL, op7_url_filter
from .warc import op1_warc_derivatives

QUERIES = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_language": op2_language,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_topk": op4_topk,
    "op5_quality": op5_quality,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_html_extraction": op8_html_extraction,
    "op9_decontamination": op9_decontamination,
    "op10_mixing": op10_mixing,
}
ORACLES = {
    "op4_topk": OP4_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op7_url_filter": OP7_SQL,
    "op9_decontamination": OP9_SQL,
}
