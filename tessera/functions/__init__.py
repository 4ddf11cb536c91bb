"""Column-expression helpers (all JVM-side, codegen-friendly)."""

from tessera.functions.text import (  # noqa: F401
    PY_WHITESPACE, words, py_strip, lower_words, file_stem, window_file_name, let,
    strip_prefix,
)
from tessera.functions.vectors import (  # noqa: F401
    l2_norm, l2_normalize, similarity_from_d2,
)
from tessera.functions.ordering import (  # noqa: F401
    md5_fraction, md5_order_key, global_index, spread,
)
