"""partqc: imbalanced binary classification of machine readings on Spark.

Subpackages:
  functions  column expressions (hash sampling, label rule, threshold rules)
  sources    table loaders, CSV, Kafka and model storage
  operators  DataFrame -> DataFrame operators (prep, profile, sampling,
             SMOTE, features, models, evaluation, distributed scans)
  plans      end-to-end flows (train-and-evaluate, model comparison) and the
             registered queries with their SQL oracles
  streaming  JSON message parsing and stream scoring
"""

__version__ = "0.1.0"
