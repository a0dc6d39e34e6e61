"""DataFrame → DataFrame operators: profile, statistics, cleaning, features, models, evaluation."""
