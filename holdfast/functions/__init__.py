"""Column expressions shared by the operators. None runs Python; the array functions with lambdas are interpreted."""
