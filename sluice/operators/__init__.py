"""DataFrame to DataFrame operators: classes, features, metrics, progress."""
