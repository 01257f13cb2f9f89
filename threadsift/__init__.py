"""threadsift: collecting, cleaning, storing and reporting on public forum
posts and application error events with PySpark DataFrames."""
