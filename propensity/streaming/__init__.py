"""Row-wise operators on streaming frames."""
