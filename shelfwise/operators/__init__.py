"""Lazy DataFrame operators.  Each takes DataFrames (+ keyword parameters) and
returns a DataFrame; none triggers an action unless its docstring says so."""
