from .columns import (as_col, binary_ratio_class, class_probability, cutoff_class,
                      label_from_text, ratio_class, round6, vector_has_invalid)
from .hashing import (TWO_32, bernoulli_keep, hash_u32, keep_bound, seeded_hash,
                      seeded_u32, seeded_uniform)
