WORDS = "the of and to in is it on as with erth onand thing shed rean bleer wholly stone river".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n))
