"""Whole plans: batch runs, publishing, ad-hoc SQL, registered queries."""
