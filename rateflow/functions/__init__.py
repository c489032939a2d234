"""Column expressions used by the operators. All are native Spark expressions."""

from rateflow.functions.hashing import java_string_hash, minhash, minhash_seed, signature_columns  # noqa: F401
from rateflow.functions.scoring import baseline_prediction, normalized_deviation, safe_ratio, scale  # noqa: F401
from rateflow.functions.tags import has_all_tags, has_any_tag, tag_array  # noqa: F401
from rateflow.functions.time import year_of_epoch  # noqa: F401
