"""Layer runs built from the operators."""
