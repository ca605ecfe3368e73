"""Image-text pair datasets on Spark."""
