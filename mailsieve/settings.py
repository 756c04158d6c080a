"""Default parameters. Every public function takes them as arguments."""

# Defaults the results depend on.
SEED = 42
MIN_TEXT_LENGTH = 20
TEST_SHARE = 0.2
MAX_FEATURES = 25000
NGRAM_RANGE = (1, 2)
NAIVE_BAYES_ALPHA = 0.5
INVERSE_REGULARISATION = 1.0

#: Safety net for the solver: reaching it is an error, so no result depends on it.
SOLVER_MAX_STEPS = 100

# The two classes of every cleaned table: 0 = ham, 1 = spam.
LABELS = (0, 1)
