"""DataFrame -> DataFrame operators: staging, models, mart, scores, quality, validation, features."""
