"""Column expressions (row-wise operators N1-N15 and hashing helpers)."""

from mixprep.functions.hashing import hash_hex, uniform01  # noqa: F401
from mixprep.functions.text import (  # noqa: F401
    py_strip, char_len, token_estimate, caption_summary, sid_token, domain_prefix,
    domain_label, history_prefix, chat_full_text, chat_prefix_text, weight_by_content,
    category_from_name, alias_merge,
)
