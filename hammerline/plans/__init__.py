"""The logical model that every query builds on, and its SQL form."""
