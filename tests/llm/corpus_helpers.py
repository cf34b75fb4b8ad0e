"""Fixed texts and paths for the corpus tests."""

SMALL = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "labels"]
WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi "
         "rho sigma tau upsilon phi chi psi omega").split()


def sentence(seed: int, n: int) -> str:
    """n words, the same for the same seed."""
    out = []
    for _ in range(n):
        seed = (seed * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(seed >> 8) % len(WORDS)])
    return " ".join(out)
