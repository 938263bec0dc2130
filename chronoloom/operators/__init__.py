"""DataFrame operators. All are lazy and take `now` and bounds as parameters."""
