"""DataFrame operators. Modules: prep, profile, scan, sampling, smote,
features, models, evaluate."""
