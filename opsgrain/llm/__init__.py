"""Training-data operators.  Nothing else in the library imports this package;
``opsgrain.llm.registry`` lists the queries that apply the operators to the
given tables."""
