"""DataFrame -> DataFrame operators (cleaning, sampling, features, models, trials)."""
