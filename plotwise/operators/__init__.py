"""DataFrame-in, DataFrame-out operators, free of any table or column naming."""
